"""Quality rules learned as a decision list, in DataFrame functions only.

Statistics of every text are counted once and stored.  Labelled rows are reduced to a table of cells:
each feature is replaced by its step on a fixed ladder of thresholds, and rows are counted by cell,
label and fold.  The table's size depends on the ladders, not on the corpus.  From it, sequential
covering learns rules for the rejected class: a rule grows by the condition of highest information
gain on two thirds of the rows, is pruned on the rest, and leaves with all cells it covers.  The list
becomes one conditional Spark expression; its first rule that holds decides.

Defined results: a null text has no words; repeated rows are judged alike; null ids stay; rows
whose id has no label, a null label or a null id teach nothing; without labels of both kinds only
the base rule decides; an empty table gives no rows.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from treadle.session import run_folder

WORD_BREAK = r"[\x20\x09-\x0D]"

_SHARE = [0.01, 0.03, 0.06, 0.12, 0.25, 0.5, 0.75]
#: Feature -> (expression over the statistics, rising thresholds).
FEATURES: dict[str, tuple[str, list[float]]] = {
    "words": ("n_words", [25, 50, 100, 200, 1000, 5000, 20000]),
    "word_length": ("word_chars / n_words", [3, 4, 4.4, 5.5, 6, 6.5, 7.5]),
    "symbols_per_word": ("n_symbols / n_words", _SHARE),
    "exclamations_per_word": ("n_exclamations / n_words", _SHARE),
    "capital_share": ("n_capitals / word_chars", _SHARE),
    "repeated_share": ("n_repeat_words / n_words", _SHARE),
    "same_line_share": ("n_dup_lines / n_lines", _SHARE),
}


def text_statistics(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text",
                    whole: bool = False) -> DataFrame:
    """Counts of each text; all of them come from the row itself, so nothing is shuffled.

    With ``whole`` the row itself stays, as ``document``.

    Words in repeated three-word windows: windows are hashed, hashes sorted with their places, and
    places whose hash stands next to an equal one give the covered words by the gaps between them.
    Windows are compared by 64-bit hashes within one text.
    """
    kept = ["id", "document"] if whole else ["id"]
    rows = docs.select(F.col(id_column).alias("id"), F.coalesce(F.col(text_column), F.lit("")).alias("text"),
                       F.struct("*").alias("document"))
    pattern = WORD_BREAK.replace("\\", "\\\\")
    split = rows.select(*kept, "text", F.expr(f"array_remove(split(text, '{pattern}+'), '')").alias("w"),
                        F.expr(f"filter(split(text, '\\n'), l -> l rlike '[^{pattern[1:]}')").alias("lines"))
    windows = split.select(*kept, "text", "w", "lines", F.size("w").alias("n"), F.expr("""
        if(size(w) < 3, array(), transform(sequence(0, size(w) - 3),
           i -> xxhash64(get(w, i), get(w, i + 1), get(w, i + 2))))""").alias("grams"))
    placed = "transform(grams, (h, i) -> struct(h as h, i as i))"
    repeated = f"""element_at(transform(array(array_sort({placed})), s -> aggregate(
        array_sort(transform(filter(s, (x, j) -> x.h = get(s, j - 1).h or x.h = get(s, j + 1).h), x -> x.i)),
        named_struct('last', -3, 'n', 0), (a, i) -> named_struct('last', i, 'n', a.n + least(3, i - a.last)),
        a -> a.n)), 1)"""
    return windows.select(
        *kept, F.col("n").cast("long").alias("n_words"),
        F.length(F.array_join("w", "")).cast("long").alias("word_chars"),
        F.expr("cast(length(text) - length(regexp_replace(text, '[#*$%&|<>]+', '')) as long)").alias("n_symbols"),
        F.expr("cast(size(lines) - size(array_distinct(lines)) as long)").alias("n_dup_lines"),
        F.expr(f"cast(if(size(array_distinct(grams)) = size(grams), 0, {repeated}) as long)").alias("n_repeat_words"),
        F.expr("cast(length(text) - length(replace(text, '!', '')) as long)").alias("n_exclamations"),
        F.expr("cast(length(text) - length(regexp_replace(text, '\\\\p{Lu}+', '')) as long)").alias("n_capitals"),
        F.size("lines").cast("long").alias("n_lines"))


def base_failed() -> Column:
    return F.expr("n_words < 50 or 100 * n_repeat_words > 50 * n_words")


def steps(thresholds: dict[str, tuple[str, list[float]]] = FEATURES) -> list[Column]:
    """Each feature's step: the number of thresholds at or below its value (no words: step 0)."""
    return [F.expr(" + ".join(f"if(coalesce(try_divide({e.replace(' / ', ', ')}), 0) >= {t}, 1, 0)"
                              if " / " in e else f"if({e} >= {t}, 1, 0)" for t in ladder)).alias(name)
            for name, (e, ladder) in thresholds.items()]


@dataclass(frozen=True)
class Rule:
    """Rows that meet every (feature, at least?, step) are rejected; counts are of labelled rows."""
    conditions: tuple[tuple[str, bool, int], ...]
    rejected: int
    good: int

    def holds(self, cell: dict) -> bool:
        return all((cell[f] >= s) == up for f, up, s in self.conditions)

    def expression(self) -> Column:
        """The conjunction over the step columns."""
        out = F.lit(True)
        for f, up, s in self.conditions:
            out = out & (F.col(f) >= s if up else F.col(f) < s)
        return out

    def __str__(self) -> str:
        return " and ".join(f"{FEATURES[f][0]} {'>=' if up else '<'} {FEATURES[f][1][s - 1]}" for f, up, s in self.conditions)


def _gain(p0: int, n0: int, p1: int, n1: int) -> float:
    """FOIL's gain of going from p0:n0 to p1:n1."""
    return p1 * (math.log2(p1 / (p1 + n1)) - math.log2(p0 / (p0 + n0))) if p1 else 0.0


def _grow(cells: list[dict], deepest: int) -> list[tuple[str, bool, int]]:
    conditions: list[tuple[str, bool, int]] = []
    while len(conditions) < deepest:
        p0, n0 = sum(c["p"] for c in cells), sum(c["n"] for c in cells)
        if not p0 or not n0:
            break
        best = (0.0, None)
        for f, (_, ladder) in FEATURES.items():
            by = [[0, 0] for _ in range(len(ladder) + 1)]
            for c in cells:
                by[c[f]][0] += c["p"]
                by[c[f]][1] += c["n"]
            low_p = low_n = 0
            for s in range(1, len(by)):
                low_p, low_n = low_p + by[s - 1][0], low_n + by[s - 1][1]
                best = max(best, (_gain(p0, n0, low_p, low_n), (f, False, s)),
                           (_gain(p0, n0, p0 - low_p, n0 - low_n), (f, True, s)), key=lambda b: b[0])
        if best[1] is None:
            break
        conditions.append(best[1])
        f, up, s = best[1]
        cells = [c for c in cells if (c[f] >= s) == up]
    return conditions


def _prune(conditions: list, cells: list[dict]) -> tuple:
    """The first conditions that do best on the rows kept for pruning."""
    best = (-2.0, ())
    for k in range(1, len(conditions) + 1):
        rule = Rule(tuple(conditions[:k]), 0, 0)
        p = sum(c["vp"] for c in cells if rule.holds(c))
        n = sum(c["vn"] for c in cells if rule.holds(c))
        best = max(best, ((p - n) / (p + n) if p + n else -1.0, rule.conditions), key=lambda b: b[0])
    return best[1]


def cover(cells: list[dict], precision: float, support: int, most: int, deepest: int) -> list[Rule]:
    """Rules in order, each at least ``precision`` right on the labelled rows that reach it."""
    rules: list[Rule] = []
    while len(rules) < most:
        conditions = _grow(cells, deepest)
        conditions = _prune(conditions, cells) if conditions else ()
        if not conditions:
            break
        trial = Rule(conditions, 0, 0)
        held = [c for c in cells if trial.holds(c)]
        p, n = sum(c["p"] + c["vp"] for c in held), sum(c["n"] + c["vn"] for c in held)
        if p < support or p < precision * (p + n):
            break
        rules.append(Rule(conditions, p, n))
        cells = [c for c in cells if not trial.holds(c)]
    return rules


def learn(statistics: DataFrame, labels: DataFrame, precision: float = 0.9, support: int = 5, most: int = 16,
          deepest: int = 4, id_column: str = "doc_id", label_column: str = "quality") -> list[Rule]:
    """Learn from all labelled rows (label 0: reject, 1: good).

    The driver gets one row per cell that occurs: at most the product of the ladders' sizes.
    """
    known = labels.select(F.col(id_column).alias("id"), F.col(label_column).alias("good")).where(
        "id is not null and good in (0, 1)")
    folded = statistics.where(~base_failed()).join(known, "id").select(
        *steps(), "good", (F.pmod(F.xxhash64("id"), F.lit(3)) == 0).alias("later"))
    count = lambda good, later: F.count(F.when((F.col("good") == good) & (F.col("later") == later), 1))
    table = folded.groupBy(*FEATURES).agg(count(0, False).alias("p"), count(1, False).alias("n"),
                                          count(0, True).alias("vp"), count(1, True).alias("vn"))
    cells = sorted((r.asDict() for r in table.collect()), key=lambda c: [c[f] for f in FEATURES])
    return cover(cells, precision, support, most, deepest)


def judge(statistics: DataFrame, rules: list[Rule]) -> DataFrame:
    """``statistics`` with base_failed, ``rule`` (number of the deciding rule, from 1; 0: base, null: none) and kept."""
    decided = F.when(F.col("base_failed"), F.lit(0))
    for k, rule in enumerate(rules, 1):
        decided = decided.when(rule.expression(), F.lit(k))
    out = statistics.withColumn("base_failed", base_failed()).select("*", *steps()).withColumn("rule", decided)
    return out.withColumn("kept", F.col("rule").isNull()).drop(*FEATURES)


def assess(spark: SparkSession, docs: DataFrame, labels: DataFrame, id_column: str = "doc_id",
           text_column: str = "text", whole: bool = False) -> DataFrame:
    """Statistics and verdict of every document; the statistics are stored, as they are read twice."""
    folder = run_folder(spark, "quality")
    text_statistics(docs, id_column, text_column, whole).write.parquet(folder)
    statistics = spark.read.parquet(folder)
    return judge(statistics, learn(statistics, labels))
