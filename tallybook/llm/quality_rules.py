"""Learned decision lists over text statistics, in DataFrame functions only.

``statistics`` measures whole texts. ``learn`` turns labelled statistics into an ordered list of rules, each a
conjunction of thresholds: sequential covering grows a rule condition by condition on one part of the labelled rows
and prunes it on the other. ``verdict`` writes the list as one Spark conditional expression.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallybook.llm.common import NOT_SPACE, row_key, stored, words_of

WINDOW = 8
#: Bounds of the bins of each statistic a rule may test; with them the learner sees at most 9 ** 6 cells of counts.
EDGES: dict[str, tuple[float, ...]] = {
    "n_words": (20, 30, 50, 100, 200, 500, 1000, 5000),
    "mean_chars": (2.5, 3, 4, 5, 6, 7.5, 10, 15),
    "symbol_rate": (0.02, 0.05, 0.1, 0.25, 0.5, 1, 1.5, 2),
    "upper_share": (0.02, 0.05, 0.1, 0.2, 0.35, 0.5, 0.7, 0.9),
    "duplicate_lines": (0.02, 0.05, 0.1, 0.2, 0.3, 0.4, 0.5, 0.7),
    "repeat_share": (0.01, 0.03, 0.06, 0.1, 0.15, 0.2, 0.25, 0.3),
}
COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_upper", "n_lines"]


@dataclass(frozen=True)
class Condition:
    """``statistic < edge`` or ``statistic >= edge``."""

    name: str
    above: bool
    edge: float

    def column(self) -> Column:
        return F.col(self.name) >= self.edge if self.above else F.col(self.name) < self.edge

    def holds(self, cell: dict) -> bool:
        """Whether a cell, whose bins count the edges at or below the value, lies on the rule's side."""
        return (cell[self.name] > EDGES[self.name].index(self.edge)) == self.above


def statistics(docs: DataFrame) -> DataFrame:
    """doc_id, row_key and the counts ``COUNTS`` (all long) of every whole text; a null text counts as empty.

    Repeated 8-word windows are found within the row: each window's 64-bit hash, cut to make room for its position,
    is sorted as a plain long, and neighbours are compared by their full hashes. The cost is that of one sort of
    longs, whatever repeats, and no row leaves its task. Columns other than doc_id and text are ignored; repeated
    rows give repeated results.
    """
    text = F.coalesce("text", F.lit(""))
    step = docs.select("doc_id", row_key().alias("row_key"), text.alias("text"))
    step = step.select("doc_id", "row_key", "text", words_of(F.col("text")).alias("words"), F.split("text", "\n", -1).alias("lines"))
    step = step.select(
        "doc_id",
        "row_key",
        F.size("words").cast("long").alias("n_words"),
        F.length(F.array_join("words", "")).cast("long").alias("word_chars"),
        F.length(F.regexp_replace("text", r"[^#*$%&|<>]+", "")).cast("long").alias("n_symbols"),
        F.length(F.regexp_replace("text", r"[^\p{Lu}]+", "")).cast("long").alias("n_upper"),
        F.size("lines").cast("long").alias("n_lines"),
        F.filter("lines", lambda line: line.rlike(NOT_SPACE)).alias("full"),
        F.transform("words", lambda word: F.xxhash64(word)).alias("hashes"),
    )
    step = step.select(
        *["doc_id", "row_key", "n_words", "word_chars", "n_symbols", "n_upper", "n_lines"],
        (F.size("full") - F.size(F.array_distinct("full"))).cast("long").alias("n_dup_lines"),
        F.when(
            F.col("n_words") >= WINDOW,
            F.transform(
                F.sequence(F.lit(1), F.size("hashes") - (WINDOW - 1)),
                lambda i: F.xxhash64(F.slice("hashes", i, WINDOW)),
            ),
        ).otherwise(F.array().cast("array<bigint>")).alias("windows"),
        F.pow(F.lit(2.0), F.ceil(F.log2(F.size("hashes") + F.lit(2)))).cast("long").alias("room"),
    )
    packed = F.transform("windows", lambda h, i: (h - F.pmod(h, F.col("room"))) + i)
    step = step.select(
        *[c for c in step.columns],
        F.when(F.size(F.array_distinct("windows")) < F.size("windows"), F.sort_array(packed))
        .otherwise(F.array().cast("array<bigint>")).alias("sorted"),
    )
    step = step.select(
        *[c for c in step.columns if c != "windows"],
        F.transform("sorted", lambda v: F.get("windows", F.pmod(v, F.col("room")).cast("int"))).alias("full_hash"),
    )
    near = lambda k, d: F.coalesce(F.get("full_hash", k + d) == F.get("full_hash", k), F.lit(False))
    twice = F.filter(F.transform("sorted", lambda v, k: F.when(near(k, -1) | near(k, 1), F.pmod(v, F.col("room")))), lambda v: v.isNotNull())
    step = step.select(*[c for c in step.columns if c not in ("sorted", "full_hash", "room")], F.sort_array(twice).alias("at"))
    gaps = F.transform("at", lambda v, k: F.least(F.lit(WINDOW).cast("long"), F.coalesce(F.get("at", k + 1) - v, F.lit(WINDOW).cast("long"))))
    return step.select(
        "doc_id", "row_key", *[c for c in COUNTS if c != "n_repeat_words"],
        F.aggregate(gaps, F.lit(0).cast("long"), lambda total, gap: total + gap).alias("n_repeat_words"),
    )


def rates(stats: DataFrame) -> DataFrame:
    """``stats`` with the double columns that rules test (those of ``EDGES``) in a struct ``rule_input``."""
    per = lambda a, b: (F.col(a) / F.greatest(F.col(b), F.lit(1)))
    return stats.withColumn(
        "rule_input",
        F.struct(
            F.col("n_words").cast("double").alias("n_words"),
            per("word_chars", "n_words").alias("mean_chars"),
            per("n_symbols", "n_words").alias("symbol_rate"),
            per("n_upper", "word_chars").alias("upper_share"),
            per("n_dup_lines", "n_lines").alias("duplicate_lines"),
            per("n_repeat_words", "n_words").alias("repeat_share"),
        ),
    )


def base_failed() -> Column:
    return (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))


def learn(labelled: DataFrame, *, precision: float = 0.9, least: int = 8, most_rules: int = 12) -> list[list[Condition]]:
    """Rules for label 0, in order, from rows (rule_input, label 0/1, fold boolean).

    The rows are counted in the cells of ``EDGES`` (a bounded table, the only thing the driver sees), split by fold
    into a part to grow on and a part to prune on. A rule grows by the condition of the highest information gain,
    loses final conditions while that doesn't worsen it on the other part, and is taken if it covers at least
    ``least`` rows and reaches ``precision`` on both parts together; rows it covers are then left out. No labels: no
    rules. Rows with a null label don't count.
    """
    bins = [
        sum(((F.col(f"rule_input.{name}") >= edge).cast("int") for edge in edges), F.lit(0)).alias(name)
        for name, edges in EDGES.items()
    ]
    counted = (
        labelled.where(F.col("label").isNotNull()).select(*bins, "label", "fold")
        .groupBy(*EDGES).agg(*[
            F.sum(((F.col("label") == label) & (F.col("fold") == fold)).cast("long")).alias(f"{kind}{label}")
            for kind, fold in (("grow", True), ("prune", False)) for label in (0, 1)
        ])
    )
    cells = sorted((row.asDict() for row in counted.collect()), key=lambda cell: [cell[name] for name in EDGES])
    options = [Condition(n, above, e) for n, edges in EDGES.items() for e in edges for above in (True, False)]
    rules: list[list[Condition]] = []
    while len(rules) < most_rules:
        rule = _pruned(_grown(cells, options), cells)
        covered = [cell for cell in cells if all(c.holds(cell) for c in rule)] if rule else []
        bad = sum(c["grow0"] + c["prune0"] for c in covered)
        good = sum(c["grow1"] + c["prune1"] for c in covered)
        if bad < least or bad < precision * (bad + good):
            break
        rules.append(rule)
        cells = [cell for cell in cells if not all(c.holds(cell) for c in rule)]
    return rules


def _grown(cells: list[dict], options: list[Condition]) -> list[Condition]:
    from math import log2

    rule: list[Condition] = []
    while True:
        bad, good = sum(c["grow0"] for c in cells), sum(c["grow1"] for c in cells)
        if not bad or not good:
            return rule
        best, gain = None, 1e-9
        for option in options:
            inside = [c for c in cells if option.holds(c)]
            b, g = sum(c["grow0"] for c in inside), sum(c["grow1"] for c in inside)
            if b and (now := b * (log2(b / (b + g)) - log2(bad / (bad + good)))) > gain:
                best, gain = option, now
        if best is None:
            return rule
        rule.append(best)
        cells = [c for c in cells if best.holds(c)]


def _pruned(rule: list[Condition], cells: list[dict]) -> list[Condition]:
    def worth(part: list[Condition]) -> float:
        inside = [c for c in cells if all(o.holds(c) for o in part)]
        bad, good = sum(c["prune0"] for c in inside), sum(c["prune1"] for c in inside)
        return (bad - good) / (bad + good) if bad + good else -1.0

    parts = [rule[:n] for n in range(1, len(rule) + 1)]
    return max(parts, key=lambda part: (worth(part), -len(part))) if parts else []


def verdict(rules: list[list[Condition]]) -> Column:
    """The decision list as one conditional expression over the struct ``rule_input``: false where a rule rejects."""
    chain = None
    for rule in rules:
        test = reduce(and_, (F.col(f"rule_input.{c.name}") >= c.edge if c.above else F.col(f"rule_input.{c.name}") < c.edge for c in rule))
        chain = F.when(test, F.lit(False)) if chain is None else chain.when(test, F.lit(False))
    return F.lit(True) if chain is None else chain.otherwise(F.lit(True))


def judged(docs: DataFrame, labels: DataFrame, **options) -> DataFrame:
    """doc_id, the counts, base_failed and kept for every row of ``docs``.

    Rules are learned from the labelled documents that pass the base rules, as only those need a verdict. ``labels``:
    doc_id, quality (1 good, 0 bad, null ignored). Texts are read once; the statistics are stored in between. Null
    texts fail the base rules; a null doc_id has no label; an empty table gives an empty result.
    """
    stats = stored(statistics(docs), "quality-statistics")
    known = labels.select(F.col("doc_id"), F.col("quality").cast("int").alias("label"))
    labelled = (
        rates(stats).where(~base_failed()).join(known, "doc_id")
        .select("rule_input", "label", (F.pmod(F.xxhash64("doc_id"), F.lit(3)) > 0).alias("fold"))
    )
    rules = learn(labelled, **options)
    return (
        rates(stats).withColumn("base_failed", base_failed())
        .withColumn("kept", ~F.col("base_failed") & verdict(rules))
        .select("doc_id", *COUNTS[:5], "base_failed", "kept", "n_upper", "n_lines", "row_key")
    )
