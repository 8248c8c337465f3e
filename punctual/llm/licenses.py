"""Licence scans: a positional index of rare words, relative positions, and phrases that must be there.

One pass over the texts writes, per row, the places of all licence words. Document frequencies follow from that table;
the index is built from them: for each template the postings (word, template, place in it) of the words that the fewest
documents contain. The places are joined with the postings; a template is a candidate at every start that all of its
rare words imply, so a text with several notices gets the labels of all. At a start the template's key phrase must
stand word for word, and the weight (IDF) of the words that are in place is the score. Both follow from the written
places as well, so texts are split once. Everything is a DataFrame operation.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from punctual.runtime import cut, kept_dir, scratch

# Base phrases with their labels, and notices of public licences with the phrase that each must hold.
PHRASES = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}
TEMPLATES = [
    ("apache", "licensed under the apache license version 2 0", "apache license"),
    ("mit", "released under the mit license", "the mit license"),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software", "permission is hereby granted free of charge"),
    ("gpl", "this work is licensed under the gnu general public license version 3", "gnu general public license"),
    ("gpl", "you can redistribute it and or modify it under the terms of the gnu general public license", "gnu general public license"),
    ("lgpl", "under the terms of the gnu lesser general public license", "lesser general public license"),
    ("agpl", "under the terms of the gnu affero general public license", "affero general public license"),
    ("cc-by-nc", "licensed under cc by nc 4 0", "cc by nc"),
    ("cc-by-sa", "licensed under cc by sa 4 0", "cc by sa"),
    ("cc-by", "licensed under a creative commons attribution 4 0 international license", "creative commons attribution"),
    ("cc0", "dedicated to the public domain under cc0 1 0 universal", "cc0 1 0"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted", "redistribution and use in source and binary forms"),
    ("mpl", "subject to the terms of the mozilla public license v 2 0", "mozilla public license"),
    ("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted", "with or without fee is hereby granted"),
]

#: Least share of a template's weight that must be in place.
LEAST = 0.6
#: Words of a template that its postings hold; all must imply the same start.
RARE = 2
RESULTS = ["n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score"]
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def words_of(text: Column) -> Column:
    """Words [^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+ after lower-casing A-Z; an empty array for null or none."""
    low = F.translate(F.coalesce(text.cast("string"), F.lit("")), UPPER, LOWER)
    plain = F.trim(F.regexp_replace(low, r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+", " "))
    return F.when(plain == "", F.array().cast("array<string>")).otherwise(F.split(plain, " "))


def _literal(words: list[str]) -> Column:
    return F.array(*(F.lit(w) for w in words))


def _stands(words: Column, at: Column, phrase: list[str]) -> Column:
    """Whether the words of a phrase stand at a place (from 0) of an array."""
    return F.slice(words, at + 1, len(phrase)) == _literal(phrase)


def places(words: Column, phrase: str) -> Column:
    """All places, from 0, where the words of a phrase stand."""
    parts = phrase.split(" ")
    none = F.array().cast("array<int>")
    every = F.when(F.size(words) >= len(parts), F.sequence(F.lit(0), F.size(words) - len(parts))).otherwise(none)
    # most texts lack the first word, so the places are tried for few
    return F.when(F.array_contains(words, parts[0]), F.filter(every, lambda i: _stands(words, i, parts))).otherwise(none)


def held_words(words: Column, vocabulary: list[str]) -> Column:
    """(word, pos) of every word of an array that is in the vocabulary."""
    every = F.when(F.size(words) > 0, F.sequence(F.lit(0), F.size(words) - 1)).otherwise(F.array().cast("array<int>"))
    here = F.filter(every, lambda i: F.get(words, i).isin(vocabulary))
    return F.transform(here, lambda i: F.struct(F.get(words, i).alias("word"), i.alias("pos")))


def template_words(spark: SparkSession, templates: list[tuple[str, str, str]]) -> DataFrame:
    """(t, label, key_at, key_n, i, word): a row per word of each template."""
    heads = []
    for t, (label, text, key) in enumerate(templates):
        words, phrase = text.split(" "), key.split(" ")
        at = next((i for i in range(len(words)) if words[i : i + len(phrase)] == phrase), None)
        if at is None:
            raise ValueError(f"the template of {label!r} lacks its key phrase {key!r}")
        values = {"t": t, "label": label, "text": text, "key_at": at, "key_n": len(phrase)}
        heads.append(F.struct(*(F.lit(v).alias(k) for k, v in values.items())))
    table = spark.range(1).select(F.explode(F.array(*heads)).alias("head")).select("head.*")
    return table.select("t", "label", "key_at", "key_n", F.posexplode(F.split("text", " ")).alias("i", "word"))


def build_index(places: DataFrame, templates: list[tuple[str, str, str]], path: str) -> tuple[DataFrame, DataFrame]:
    """The templates' words with their weights, and the postings (word, t, i, needed) of the RARE rarest of each.

    ``places`` has a row per text with ``held``. Weights are ln((rows + 1) / (rows with the word + 1)).
    """
    spark, rows = places.sparkSession, places.count()
    present = places.select(F.explode(F.array_distinct(F.transform("held", lambda h: h["word"]))).alias("word"))
    frequency = present.groupBy("word").agg(F.count(F.lit(1)).alias("df"))
    weight = F.round(F.log((F.lit(rows) + 1) / (F.coalesce("df", F.lit(0)) + 1)), 9)
    weighed = template_words(spark, templates).join(frequency, "word", "left").withColumn("weight", weight).drop("df")
    weighed = cut(weighed, path=f"{path}/templates")
    once = weighed.groupBy("t", "word", "weight").agg(F.min("i").alias("i"))
    ranked = once.withColumn("rank", F.row_number().over(Window.partitionBy("t").orderBy(F.desc("weight"), "word"))).where(F.col("rank") <= RARE)
    needed = F.count(F.lit(1)).over(Window.partitionBy("t"))
    return weighed, cut(ranked.select("word", "t", "i", needed.alias("needed")), path=f"{path}/postings")


def matches(places: DataFrame, weighed: DataFrame, postings: DataFrame, path: str) -> DataFrame:
    """(id, found, share): labels of the templates that stand in a text, and the greatest share of a weight in place."""
    each = places.select("id", F.explode("held").alias("h")).select("id", "h.word", "h.pos")
    starts = each.join(postings, "word").groupBy("id", "t", (F.col("pos") - F.col("i")).alias("start"), "needed").agg(F.count(F.lit(1)).alias("n"))
    starts = cut(starts.where("n = needed").select("id", "t", "start"), path=f"{path}/starts")
    near = places.join(starts.select("id").distinct(), "id", "left_semi").select("id", F.explode("held").alias("h"))
    near = near.select("id", F.col("h.pos").alias("at"), F.col("h.word").alias("stands"))
    wanted = starts.join(weighed, "t").withColumn("at", F.col("start") + F.col("i"))
    in_place = F.coalesce(F.col("stands") == F.col("word"), F.lit(False))
    is_key = (F.col("i") >= F.col("key_at")) & (F.col("i") < F.col("key_at") + F.col("key_n"))
    placed = wanted.join(near, ["id", "at"], "left").groupBy("id", "t", "start", "label", "key_n").agg(
        F.count_if(in_place & is_key).alias("keys"),
        F.try_divide(F.sum(F.when(in_place, F.col("weight")).otherwise(0.0)), F.sum("weight")).alias("share"),
    )
    good = placed.where((F.col("keys") == F.col("key_n")) & (F.col("share") >= LEAST))
    return good.groupBy("id").agg(F.collect_set("label").alias("found"), F.max("share").alias("share"))


def scan(df: DataFrame, text: str = "text", templates: list[tuple[str, str, str]] | None = None, keep_text: bool = True) -> DataFrame:
    """``df`` with n_words, n_base, first_word, last_word, base_labels, labels and score.

    The first five follow the base phrases alone. ``labels`` adds those of templates found by the index; ``score`` is
    the greatest share of a template's weight in place among them, 0.5 at least where a base phrase stands, else 0.
    ``templates`` lists (label, text, key phrase), lower-case words with single spaces, whole licences as well as single
    sentences; the key phrase must stand in its text. Null and empty texts, and texts without words, have no places,
    labels '' and score 0. Other columns are kept (``text`` unless ``keep_text`` is off), those with the names of the
    results replaced; repeated rows get equal results, an empty table an empty one.
    """
    spark = df.sparkSession
    templates = TEMPLATES if templates is None else templates
    vocabulary = sorted({w for _, t, _ in templates for w in t.split(" ")})
    own = [c for c in df.columns if c not in RESULTS and (keep_text or c != text)]
    row = F.struct(*(F.col(f"`{c}`") for c in own)) if own else F.lit(0)
    split = df.select(row.alias("row"), words_of(F.col(f"`{text}`")).alias("words"))
    words = F.col("words")
    read = split.select(
        F.monotonically_increasing_id().alias("id"),
        "row",
        F.size(words).cast("long").alias("n_words"),
        F.array(*(places(words, p) for p in PHRASES)).alias("base"),
        held_words(words, vocabulary).alias("held"),
    )
    read = cut(read, path=kept_dir(spark, "licences"))
    with scratch(spark, "licence_index") as work:
        weighed, postings = build_index(read, templates, work)
        found = cut(matches(read, weighed, postings, work), path=kept_dir(spark, "licence_matches"))
        rare = [r["word"] for r in postings.select("word").distinct().collect()]  # RARE words a template at most
    # only texts that hold a rare word can have a match, so the others need no join
    may = F.exists("held", lambda h: h["word"].isin(rare)) if rare else F.lit(False)
    none = {"found": F.array().cast("array<string>"), "share": F.lit(None).cast("double")}
    out = read.where(may).join(found, "id", "left").unionByName(read.where(~may).withColumns(none))
    at = F.flatten("base")
    base = F.filter(F.array(*(F.when(F.size(F.col("base")[i]) > 0, F.lit(label)) for i, label in enumerate(PHRASES.values()))), lambda x: x.isNotNull())
    every = F.concat(base, F.coalesce("found", none["found"]))
    return out.select(
        *(F.col(f"row.`{c}`").alias(c) for c in own),
        "n_words",
        F.size(at).cast("long").alias("n_base"),
        F.array_min(at).cast("long").alias("first_word"),
        F.array_max(at).cast("long").alias("last_word"),
        F.array_join(F.array_sort(F.array_distinct(base)), ",").alias("base_labels"),
        F.array_join(F.array_sort(F.array_distinct(every)), ",").alias("labels"),
        F.round(F.greatest(F.coalesce("share", F.lit(0.0)), F.when(F.size(at) > 0, F.lit(0.5)).otherwise(0.0)), 6).alias("score"),
    )
