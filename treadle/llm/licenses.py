"""License notices by diagonal voting, in DataFrame functions only.

Every run of ``K`` words of a text is hashed and joined to the places of the same run in the
templates.  A match votes for the diagonal ``place in the text - place in the template``.  Votes are
chained in the order of both places, on one diagonal or from one to a neighbouring one (words put in
or left out shift a notice there), so a place of the template counts once.  Then the span is verified:
its chain has to cover enough of the template's runs and of the span's own words, and where spans
overlap, the template with most words in common and fewest missing or put in is the notice.  A phrase
is a template that has to be covered whole on one diagonal; it stands beside any notice.

Defined results: a null text counts as empty; a text without words has no notices and score 0; each
input row gives one row, also for repeated and null ids; an empty table gives no rows.
"""

from __future__ import annotations

import re
from collections import Counter

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Words in a run.
K = 3
#: Words a notice may gain or lose between two runs that match.
DRIFT = 3
#: Share of a template's runs, and of its own words, that a notice covers.
LEAST_COVER = 0.6

# Phrases whose words have to stand consecutively, and wordings of public licenses.
PHRASES = [("mit", "under the mit license"), ("apache-2", "apache license version 2"), ("cc-by-nc", "cc by nc")]
NOTICES = [
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
            "associated documentation files (the \"Software\"), to deal in the Software without restriction"),
    ("mit", "Released under the MIT License"),
    ("mit", "Licensed under the MIT License"),
    ("apache-2", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file "
                 "except in compliance with the License"),
    ("apache-2", "Licensed under the Apache License, Version 2.0"),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted "
            "provided that the following conditions are met"),
    ("gpl", "This program is free software: you can redistribute it and/or modify it under the terms of the "
            "GNU General Public License as published by the Free Software Foundation"),
    ("gpl-3", "This work is licensed under the GNU General Public License, version 3"),
    ("mpl-2", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0"),
    ("cc-by", "This work is licensed under a Creative Commons Attribution 4.0 International License"),
    ("cc-by-nc", "Licensed under CC BY-NC 4.0"),
    ("cc-by-sa", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License"),
]
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def words_of(text: str) -> list[str]:
    return re.findall(WORD, text.lower())


def listed(phrases, notices) -> list[tuple[bool, str, str]]:
    """All templates as (to be covered whole, label, text)."""
    return [(True, *p) for p in phrases] + [(False, *n) for n in notices]


def template_runs(spark: SparkSession, phrases, notices) -> DataFrame:
    """A row per run of a template: run hash, template, its place, number of runs, most places of one run, label and kind."""
    rows = []
    for number, (exact, label, text) in enumerate(listed(phrases, notices), 1):
        words = words_of(text)
        if len(words) < K:
            raise ValueError(f"a template needs {K} words: {text!r}")
        runs = len(words) - K + 1
        repeats = max(Counter(tuple(words[at:at + K]) for at in range(runs)).values())
        rows += [(number, at, runs, repeats, label, exact, *words[at:at + K]) for at in range(runs)]
    names = [f"w{k}" for k in range(K)]
    schema = "template int, at int, runs int, repeats int, label string, exact boolean, " + ", ".join(f"{n} string" for n in names)
    return spark.createDataFrame(rows, schema).withColumn("run", F.xxhash64(*names)).drop(*names)


def scan(docs: DataFrame, phrases=PHRASES, notices=NOTICES, id_column: str = "doc_id",
         text_column: str = "text") -> DataFrame:
    """One row per input row: id, n_words, n_base, first_word, last_word, base_labels, labels, score.

    ``spans`` lists the notices: template label, first word, words spanned and share covered.
    """
    spark = docs.sparkSession
    # the templates are the only broadcast side: a list of this module or the caller's, not data
    templates = F.broadcast(template_runs(spark, phrases, notices))
    texts = docs.select(F.monotonically_increasing_id().alias("row"), F.col(id_column).alias("id"),
                        F.lower(F.coalesce(F.col(text_column), F.lit(""))).alias("text"))
    words = texts.select("row", "id", F.expr(f"regexp_extract_all(text, '({WORD})', 1)".replace("\\", "\\\\")).alias("w"))
    counted = words.withColumn("n_words", F.size("w").cast("long"))
    hashes = F.expr(f"""if(n_words < {K}, array(), transform(sequence(0, int(n_words) - {K}),
        i -> xxhash64({', '.join(f'get(w, i + {k})' for k in range(K))})))""")
    # the last entry stands for the row itself, so rows without a match stay
    runs = counted.select("row", "id", "n_words", F.posexplode(F.array_append(hashes, F.lit(0).cast("long"))).alias("pos", "hash"))
    own = F.col("pos") == F.greatest(F.col("n_words") - (K - 1), F.lit(0))
    votes = runs.join(templates, (F.col("hash") == F.col("run")) & ~own, "left").where(own | F.col("template").isNotNull())
    matched = votes.groupBy("row", "template").agg(
        F.first("id").alias("id"), F.first("n_words").alias("n_words"), F.first("label").alias("label"),
        F.first("exact").alias("exact"), F.first("runs").alias("runs"), F.first("repeats").alias("repeats"),
        F.array_sort(F.collect_list(F.when(F.col("template").isNotNull(), F.struct("pos", "at")))).alias("places"))
    groups = matched.withColumn("chains", chains()).withColumn(
        "base", F.transform(F.filter("chains", lambda c: F.col("exact") & (c["n"] == F.col("runs"))), lambda c: c["first"])).withColumn(
        "cover", F.coalesce(F.array_max(F.transform("chains", lambda c: c["n"])), F.lit(0)) / F.col("runs")).withColumn(
        "notices", F.transform(F.filter("chains", lambda c: ~F.col("exact") & verified(c)), rated))
    label = F.when(F.size("base") > 0, F.col("label"))
    phrase = lambda at: F.struct(at.alias("first"), (F.col("runs") + (K - 1)).alias("n"), "label", F.lit(1.0).alias("cover"))
    rows = groups.groupBy("row").agg(
        F.first("id").alias("id"), F.max("n_words").alias("n_words"), F.sum(F.size("base")).alias("n_base"),
        F.min(F.array_min("base")).cast("long").alias("first_word"), F.max(F.array_max("base")).cast("long").alias("last_word"),
        F.collect_set(label).alias("base_labels"),
        F.coalesce(F.max(F.when(~F.col("exact") | (F.size("base") > 0), F.col("cover"))), F.lit(0.0)).alias("score"),
        F.flatten(F.collect_list(F.transform("base", phrase))).alias("phrases"),
        F.flatten(F.collect_list("notices")).alias("notices"))
    spans = F.transform(best(F.col("notices")), lambda c: F.struct(*[c[f].alias(f) for f in ("first", "n", "label", "cover")]))
    names = lambda found: F.array_join(F.array_sort(found), ",")
    return rows.withColumn("spans", F.array_sort(F.concat("phrases", spans))).select(
        "id", "n_words", "n_base", "first_word", "last_word", names(F.col("base_labels")).alias("base_labels"),
        names(F.array_distinct(F.transform("spans", lambda c: c["label"]))).alias("labels"), "score", "spans")


def chains() -> Column:
    """For each of ``places`` the longest chain that ends there: places, words in common, first and last word's run."""
    drift = F.when(F.col("exact"), 0).otherwise(DRIFT)
    chain = "array<struct<n: int, same: int, first: int, pos: int, at: int>>"

    def follow(done: Column, place: Column) -> Column:
        # a place of the text has as many matches at most as its run has places in the template
        near = F.slice(done, -F.least(F.size(done), (F.col("runs") + DRIFT) * F.col("repeats")), (F.col("runs") + DRIFT) * F.col("repeats"))
        near = F.when(F.size(done) > 0, near).otherwise(done)
        before = F.filter(near, lambda c: (c["pos"] < place["pos"]) & (c["at"] < place["at"])
                          & (F.abs(place["pos"] - place["at"] - c["pos"] + c["at"]) <= drift))
        longer = F.array_max(F.transform(before, lambda c: F.struct(
            (c["n"] + 1).alias("n"), (c["same"] + F.least(F.lit(K), place["pos"] - c["pos"], place["at"] - c["at"])).alias("same"),
            c["first"].alias("first"))))
        alone = F.struct(F.lit(1).alias("n"), F.lit(K).alias("same"), place["pos"].alias("first"))
        found = F.coalesce(longer, alone)
        return F.concat(done, F.array(F.struct(*[found[f].alias(f) for f in ("n", "same", "first")],
                                               place["pos"].alias("pos"), place["at"].alias("at"))).cast(chain))
    return F.aggregate("places", F.array().cast(chain), follow)


def _span(c: Column) -> Column:
    return c["pos"] - c["first"] + K


def verified(c: Column) -> Column:
    """Whether a chain covers enough of its template and of its own span."""
    return (c["n"] / F.col("runs") >= LEAST_COVER) & (c["same"] >= LEAST_COVER * _span(c))


def rated(c: Column) -> Column:
    """A chain as a span; ``worth`` is its words in common less those missing and those put in."""
    return F.struct((-(3 * c["same"] - (F.col("runs") + (K - 1)) - _span(c))).alias("worth"), c["first"].alias("first"),
                    _span(c).alias("n"), F.col("label").alias("label"), (c["n"] / F.col("runs")).alias("cover"))


def best(notices: Column) -> Column:
    """The spans of most worth that overlap with none of more."""
    kind = "array<struct<worth: int, first: int, n: int, label: string, cover: double>>"
    apart = lambda a, b: (a["first"] + a["n"] <= b["first"]) | (b["first"] + b["n"] <= a["first"])
    return F.aggregate(F.array_sort(notices), F.array().cast(kind), lambda kept, c: F.when(
        F.forall(kept, lambda k: apart(k, c)), F.concat(kept, F.array(c).cast(kind))).otherwise(kept))


def oracle() -> str:
    """The same rows in DuckDB SQL, with the words themselves in place of their hashes."""
    values = [f"({number}, {at}, {len(words) - K + 1}, '{label}', {exact}, '{' '.join(words[at:at + K])}')"
              for number, (exact, label, text) in enumerate(listed(PHRASES, NOTICES), 1)
              for words in [words_of(text)] for at in range(len(words) - K + 1)]
    upper = "".join(map(chr, range(65, 91)))
    return f"""
with t(template, place, runs, label, exact, run) as (values {', '.join(values)}),
d as (select row_number() over () r, doc_id,
        regexp_extract_all(translate(coalesce(text, ''), '{upper}', '{upper.lower()}'), '{WORD}') w from documents),
p as (select r, w, unnest(range(1, greatest(len(w) - {K - 2}, 1))) i from d),
v as (select r, template, i - 1 - place diagonal, any_value(label) label, any_value(exact) exact, any_value(runs) runs,
        count(*) votes, min(i - 1) first_at from p join t on t.run = array_to_string(w[i:i + {K - 1}], ' ') group by all),
f as (select *, case when exact or coalesce(diagonal - lag(diagonal) over n > {DRIFT}, true) then 1 else 0 end fresh
        from v window n as (partition by r, template order by diagonal)),
c as (select *, sum(fresh) over (partition by r, template order by diagonal) grp from f),
g as (select r, template, grp, any_value(label) label, any_value(exact) exact, min(first_at) first_at,
        least(sum(votes), any_value(runs)) / any_value(runs)::double cover from c group by all),
s as (select r, count(*) filter (exact and cover = 1) n_base, min(first_at) filter (exact and cover = 1) first_word,
        max(first_at) filter (exact and cover = 1) last_word,
        array_to_string(list_sort(list(distinct label) filter (exact and cover = 1)), ',') base_labels,
        array_to_string(list_sort(list(distinct label) filter (case when exact then cover = 1 else cover >= {LEAST_COVER} end)), ',') labels,
        max(cover) filter (not exact or cover = 1) score from g group by r)
select doc_id, len(w)::bigint n_words, coalesce(n_base, 0) n_base, first_word, last_word,
  coalesce(base_labels, '') base_labels, coalesce(labels, '') labels, coalesce(score, 0)::double score
from d left join s using (r)"""
