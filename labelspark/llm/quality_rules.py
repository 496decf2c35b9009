"""Quality rules: decision lists learned by sequential covering, applied as ordered Spark conditions.

Everything is DataFrame and SQL functions. The statistics of a text come from array functions within its row, so all
that is shuffled while learning is counts, and applying a list is a narrow stage.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import stage
from .common import BLANK_CLASS, bounded_sample, let, narrow, word_array

WINDOW = 8
# Statistics that conditions may test, each a double.
FEATURES = ("n_words", "mean_word_chars", "symbol_share", "dup_line_share", "repeat_share", "upper_share",
            "distinct_share")


@dataclass(frozen=True)
class Condition:
    """``feature >= cut`` or ``feature < cut``; ``bin`` is the place of the cut among the feature's cuts."""

    feature: str
    at_least: bool
    cut: float
    bin: int

    def column(self) -> Column:
        x = F.col(self.feature)
        return x >= self.cut if self.at_least else x < self.cut

    def binned(self) -> Column:
        x = F.col(f"b_{self.feature}")
        return x >= self.bin if self.at_least else x < self.bin

    def __str__(self) -> str:
        return f"{self.feature} {'>=' if self.at_least else '<'} {self.cut:g}"


@dataclass(frozen=True)
class Rule:
    conditions: tuple[Condition, ...]
    covered: int
    precision: float

    def column(self) -> Column:
        return reduce(lambda a, b: a & b, (c.column() for c in self.conditions))

    def binned(self) -> Column:
        return reduce(lambda a, b: a & b, (c.binned() for c in self.conditions))

    def __str__(self) -> str:
        return " and ".join(map(str, self.conditions)) + f" -> reject ({self.covered} rows, {self.precision:.3f})"


@dataclass
class DecisionList:
    """Rules that reject, tried in order; a row that none of them fits is kept."""

    rules: list[Rule] = field(default_factory=list)

    def rule_no(self) -> Column:
        """Place of the first rule that fits, from 1; null if none does."""
        out = None
        for i, rule in enumerate(self.rules, 1):
            out = F.when(rule.column(), i) if out is None else out.when(rule.column(), i)
        return F.lit(None).cast("int") if out is None else out.cast("int")

    def rejects(self) -> Column:
        return F.coalesce(self.rule_no() > 0, F.lit(False))


def _repeat_words(hashes: Column) -> Column:
    """Words inside windows of eight words that occur twice or more in the text."""

    def covered(windows: Column) -> Column:
        by_hash = F.sort_array(F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
        twice = let(by_hash, lambda s: F.transform(F.filter(
            F.transform(s, lambda x, j: F.struct(x["i"].alias("i"), (
                F.coalesce(F.get(s, j - 1)["h"] == x["h"], F.lit(False))
                | F.coalesce(F.get(s, j + 1)["h"] == x["h"], F.lit(False))).alias("d"))),
            lambda x: x["d"]), lambda x: x["i"]))
        return F.aggregate(
            F.sort_array(twice), F.struct(F.lit(0).alias("n"), F.lit(-WINDOW).alias("last")),
            lambda a, p: F.struct((a["n"] + F.least(F.lit(WINDOW), p - a["last"])).alias("n"), p.alias("last")),
            lambda a: a["n"].cast("long"))

    def of(h: Column) -> Column:
        starts = F.sequence(F.lit(0), F.size(h) - WINDOW)
        windows = F.transform(starts, lambda i: F.xxhash64(*(F.get(h, i + k) for k in range(WINDOW))))
        return let(windows, lambda w: F.when(F.size(F.array_distinct(w)) == F.size(w), F.lit(0).cast("long"))
                   .otherwise(covered(w)))

    return let(hashes, lambda h: F.when(F.size(h) < WINDOW + 1, F.lit(0).cast("long")).otherwise(of(h)))


def with_statistics(docs: DataFrame) -> DataFrame:
    """``doc_id`` and the statistics of ``text``: the counts first, then the shares that rules test."""
    words = docs.select("doc_id", "text", word_array(F.col("text")).alias("words"))
    lines = F.filter(F.split("text", "\n"), lambda line: line.rlike(r"[^\x20\x09-\x0D]"))
    counts = words.select(
        "doc_id",
        F.size("words").cast("long").alias("n_words"),
        F.length(F.array_join("words", "")).cast("long").alias("word_chars"),
        F.regexp_count("text", F.lit(r"[#*$%&|<>]")).cast("long").alias("n_symbols"),
        F.regexp_count("text", F.lit(r"\p{Lu}")).alias("n_upper"),
        let(lines, lambda a: F.struct(F.size(a).alias("n"), F.size(F.array_distinct(a)).alias("d"))).alias("lines"),
        let(F.transform("words", lambda w: F.xxhash64(w)),
            lambda h: F.struct(_repeat_words(h).alias("repeat"), F.size(F.array_distinct(h)).alias("d"))).alias("w"))
    chars, n = F.greatest("word_chars", F.lit(1)), F.greatest("n_words", F.lit(1))
    return counts.select(
        "doc_id", "n_words", "word_chars", "n_symbols",
        (F.col("lines.n") - F.col("lines.d")).cast("long").alias("n_dup_lines"),
        F.col("w.repeat").alias("n_repeat_words"),
        (F.col("word_chars") / n).alias("mean_word_chars"), (F.col("n_symbols") / chars).alias("symbol_share"),
        ((F.col("lines.n") - F.col("lines.d")) / F.greatest(F.col("lines.n"), F.lit(1))).alias("dup_line_share"),
        (F.col("w.repeat") / n).alias("repeat_share"), (F.col("n_upper") / chars).alias("upper_share"),
        (F.col("w.d") / n).alias("distinct_share"))


def base_failed() -> Column:
    """The fixed floor: under 20 words, or over 30 % of the words inside repeated windows."""
    return (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))


def _bin(feature: str, cuts: list[float]) -> Column:
    """How many of the cuts a feature reaches."""
    x = F.col(feature)
    return F.size(F.filter(F.array(*map(F.lit, cuts)).cast("array<double>"), lambda c: x >= c))


def _gain(p0: float, n0: float, p: float, n: float) -> float:
    """FOIL's information gain of narrowing a rule from (p0, n0) to (p, n) covered rows."""
    if p == 0:
        return 0.0
    return p * (math.log2(p / (p + n)) - math.log2(p0 / (p0 + n0)))


def learn_rules(stats: DataFrame, labels: DataFrame, *, label_col: str = "quality", key: str = "doc_id",
                max_rules: int = 8, max_conditions: int = 4, min_covered: int = 8, min_precision: float = 0.97,
                n_cuts: int = 32) -> DecisionList:
    """Sequential covering over labelled statistics (label 0: reject, 1: keep; null labels take no part).

    ``stats`` has a row per labelled key. Two thirds of the rows grow a rule, condition by condition, by FOIL gain; the
    last third prunes its tail by (p - n) / (p + n) and decides if the rule is accepted. Rows that an accepted rule
    covers leave, and the next rule grows on the rest. Each step is one aggregation into at most
    features x cuts x 4 counts; only counts reach the driver. Empty or one-sided labels give an empty list.
    """
    y = labels.filter(F.col(label_col).isNotNull()).groupBy(F.col(key)).agg(F.min(label_col).alias("_y"))
    known = stats.join(y, stats["doc_id"] == y[key]).select(stats["doc_id"], *FEATURES, "_y")
    probs = [i / (n_cuts + 1) for i in range(1, n_cuts + 1)]
    rows = stage(known, "rule-rows")
    cuts = rows.agg(*(F.percentile_approx(f, F.lit(probs).cast("array<double>"), 10000).alias(f) for f in FEATURES)).first()
    cuts = {f: sorted(set(cuts[f] or ())) for f in FEATURES}
    binned = stage(rows.select(
        (F.pmod(F.xxhash64("doc_id", F.lit(5)), F.lit(3)) == 0).alias("prune"), (F.col("_y") == 0).alias("bad"),
        *(_bin(f, cuts[f]).alias(f"b_{f}") for f in FEATURES)), "rule-bins")
    cells = F.explode(F.array(*(F.struct(F.lit(f).alias("f"), F.col(f"b_{f}").alias("b")) for f in FEATURES)))
    found: list[Rule] = []
    for _ in range(max_rules):
        left = reduce(lambda a, r: a & ~r.binned(), found, F.lit(True))
        rest = binned.filter(left)
        conditions: list[Condition] = []
        while len(conditions) < max_conditions:
            now = reduce(lambda a, c: a & c.binned(), conditions, ~F.col("prune"))
            hist: dict[str, dict[int, list[int]]] = {f: {} for f in FEATURES}
            for r in rest.filter(now).select("bad", cells.alias("c")).groupBy("c.f", "c.b", "bad").count().collect():
                hist[r["f"]].setdefault(r["b"], [0, 0])[0 if r["bad"] else 1] += r["count"]
            p0, n0 = (sum(v[i] for v in hist["n_words"].values()) for i in (0, 1))
            if p0 == 0 or n0 == 0:
                break
            best = (1e-9, None)
            for f in FEATURES:
                p = n = 0
                for b in range(len(cuts[f]), 0, -1):
                    p, n = p + hist[f].get(b, (0, 0))[0], n + hist[f].get(b, (0, 0))[1]
                    for up, (pp, nn) in ((True, (p, n)), (False, (p0 - p, n0 - n))):
                        if (g := _gain(p0, n0, pp, nn)) > best[0]:
                            best = (g, Condition(f, up, float(cuts[f][b - 1]), b))
            if best[1] is None:
                break
            conditions.append(best[1])
        if not conditions:
            break
        heads = [reduce(lambda a, c: a & c.binned(), conditions[:k], F.lit(True)) for k in range(1, len(conditions) + 1)]
        got = rest.filter("prune").agg(*(F.count_if(h & (F.col("bad") == want)).alias(f"{k}{want}")
                                         for k, h in enumerate(heads) for want in (True, False))).first()
        worth = [((got[f"{k}True"] - got[f"{k}False"]) / max(1, got[f"{k}True"] + got[f"{k}False"]), -k)
                 for k in range(len(heads))]
        k = -max(worth)[1]
        good, wrong = got[f"{k}True"], got[f"{k}False"]
        if good + wrong < min_covered or good / (good + wrong) < min_precision:
            break
        found.append(Rule(tuple(conditions[:k + 1]), good + wrong, good / (good + wrong)))
    return DecisionList(found)


def fit(docs: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", key: str = "doc_id",
        label_col: str = "quality", max_labelled: int = 30_000, **options) -> DecisionList:
    """A decision list from a table of texts and one of labels.

    At most about ``max_labelled`` labelled rows take part, chosen by a hash of the key; their keys, and only they,
    may be broadcast, so learning reads the texts once and shuffles none of them.
    """
    chosen = bounded_sample(labels.filter(F.col(label_col).isNotNull() & F.col(key).isNotNull()).select(key, label_col),
                            key, max_labelled)
    keys = F.broadcast(chosen.select(F.col(key).alias("_k")).distinct())
    texts = narrow(docs, id_col, text_col)
    return learn_rules(with_statistics(texts.join(keys, F.col("doc_id") == F.col("_k"), "left_semi")), chosen,
                       label_col=label_col, key=key, **options)


def judge(docs: DataFrame, rules: DecisionList, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """A row per document: counts, ``base_failed``, the number of the rule that rejects it, and ``kept``.

    A null text counts as an empty one: no words, so the base fails. Repeated rows are judged one by one; ids may be
    null. Other columns of the input do not matter, whatever their names.
    """
    out = with_statistics(narrow(docs, id_col, text_col))
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                      base_failed().alias("base_failed"), rules.rule_no().alias("rule_no"),
                      (~base_failed() & ~rules.rejects()).alias("kept"))


def keep(docs: DataFrame, rules: DecisionList, *, text_col: str = "text") -> DataFrame:
    """The rows whose text passes, with all their columns; one narrow stage."""
    row = F.struct(*(F.col(f"`{c}`") for c in docs.columns))
    judged = with_statistics_of(docs.select(row.alias("row"), F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("text")))
    return judged.filter(~base_failed() & ~rules.rejects()).select("row.*")


def with_statistics_of(rows: DataFrame) -> DataFrame:
    """``with_statistics`` of a table (row, text), with the whole row in place of its id."""
    return with_statistics(rows.withColumnRenamed("row", "doc_id")).withColumnRenamed("doc_id", "row")
