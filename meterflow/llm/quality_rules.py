"""Quality rules: a decision list of thresholds on text statistics, learned by sequential covering.

All of it is DataFrame expressions and aggregations. Statistics are computed per document inside
its row. For learning, labelled rows are joined to them and every feature is cut into bins at its
quantiles (approximate ones: beyond some ten thousand labelled rows cuts, and so the list, may differ
a little with the partitioning); a third of the rows, by a hash of the id, is the prune set, the rest the grow set. A
rule for "reject" grows by the condition (feature above or at most a cut) with the largest
information gain on the rows that no earlier rule covers: one aggregation counts labels per
feature and bin, which gives every condition's counts. It is then pruned to the prefix that does
best on the prune set, and added if it is precise enough. The list ends when no rule is. The
learned list becomes one ordered CASE expression: the first rule that holds rejects, else keep.

Words are runs of characters other than space and \\x09-\\x0D. Null and empty texts have zero for
every statistic. Labels that are null or not 0 or 1 are left out; without labels of both kinds the
list is empty and keeps everything. If an id has several labels, the largest counts. Null ids are
never labelled. Repeated rows get equal verdicts. Of conditions with equal gain the first by name and
cut is taken. Texts are read whole, however long. An empty table gives no rows. Other columns are
not read, whatever their names. `judge` learns from rows that the base rules leave open.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meterflow.plans.stage import staged

SPACES = " \t\n\x0b\f\r"
BREAK = r"[\x20\x09-\x0D]+"
SYMBOLS = "#*$%&|<>"
WINDOW = 8


def _without(text: Column, chars: str) -> Column:
    for c in chars:
        text = F.replace(text, F.lit(c), F.lit(""))
    return text


def _at(array: str, i: Column) -> Column:
    return F.get(F.col(array), i)


def statistics(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id_col, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_lines, n_distinct, n_upper).

    n_repeat_words counts the words inside 8-word windows that occur twice or more in the text:
    windows are hashed, texts whose hashes are all distinct are done, and in the others the
    hashes are sorted with their places to find those with an equal neighbour.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    bare = F.btrim("text", F.lit(SPACES))
    rows = docs.select(F.col(id_col).alias("id"), text.alias("text"))
    lines = F.filter(F.split("text", "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    solid = _without(F.col("text"), SPACES)
    counted = rows.select(
        "id",
        F.when(bare == "", F.array().cast("array<bigint>")).otherwise(F.transform(F.split(bare, BREAK), lambda w: F.xxhash64(w))).alias("h"),
        F.char_length(solid).cast("long").alias("word_chars"),
        (F.octet_length("text") - F.octet_length(_without(F.col("text"), SYMBOLS))).cast("long").alias("n_symbols"),
        lines.alias("lines"),
        (F.octet_length("text") - F.octet_length(F.regexp_replace("text", "[A-Z]+", ""))).cast("long").alias("n_upper"),
    )
    n = F.size("h")
    windows = F.transform(F.sequence(F.lit(0), n - WINDOW), lambda i: F.xxhash64(*(_at("h", i + k) for k in range(WINDOW))))
    counted = counted.select(
        "id",
        n.cast("long").alias("n_words"),
        "word_chars",
        "n_symbols",
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.size("lines").cast("long").alias("n_lines"),
        F.size(F.array_distinct("h")).cast("long").alias("n_distinct"),
        "n_upper",
        F.when(n >= WINDOW, windows).otherwise(F.array().cast("array<bigint>")).alias("w"),
    )
    keep = [c for c in counted.columns if c != "w"]
    repeats = F.size("w") > F.size(F.array_distinct("w"))
    placed = counted.select(*keep, F.when(repeats, F.array_sort(F.transform("w", lambda x, i: F.struct(x.alias("h"), i.alias("i"))))).alias("s"))
    twice = F.filter("s", lambda x, j: (x["h"] == _at("s", j - 1)["h"]) | (x["h"] == _at("s", j + 1)["h"]))
    found = placed.select(*keep, F.array_sort(F.transform(twice, lambda x: x["i"])).alias("p"))
    # places in order; each window adds the words beyond the end of the one before it
    covered = F.aggregate(
        "p",
        F.struct(F.lit(0).alias("end"), F.lit(0).alias("n")),
        lambda a, x: F.struct((x + WINDOW).alias("end"), (a["n"] + x + WINDOW - F.greatest(a["end"], x)).alias("n")),
        lambda a: a["n"],
    )
    return found.select(*keep, F.coalesce(covered, F.lit(0)).cast("long").alias("n_repeat_words")).withColumnRenamed("id", id_col)


#: What rules may test, from the columns of `statistics`.
FEATURES: dict[str, str] = {
    "n_words": "n_words",
    "word_length": "word_chars / greatest(n_words, 1)",
    "symbols_per_word": "n_symbols / greatest(n_words, 1)",
    "dup_line_share": "n_dup_lines / greatest(n_lines, 1)",
    "repeat_share": "n_repeat_words / greatest(n_words, 1)",
    "distinct_share": "n_distinct / greatest(n_words, 1)",
    "upper_share": "n_upper / greatest(word_chars, 1)",
}


@dataclass(frozen=True)
class Settings:
    bins: int = 32
    max_rules: int = 8
    max_conditions: int = 3
    min_precision: float = 0.9
    min_covered: int = 3


@dataclass(frozen=True)
class Condition:
    feature: str
    above: bool
    cut: float
    bin: int

    def on_bins(self) -> Column:
        return F.col(self.feature) >= self.bin if self.above else F.col(self.feature) < self.bin

    def on_values(self) -> Column:
        value = F.expr(FEATURES[self.feature])
        return value > F.lit(self.cut) if self.above else value <= F.lit(self.cut)

    def __str__(self) -> str:
        return f"{FEATURES[self.feature]} {'>' if self.above else '<='} {self.cut!r}"


@dataclass(frozen=True)
class DecisionList:
    """Ordered rules for rejection; each is a conjunction of conditions."""

    rules: list[list[Condition]] = field(default_factory=list)

    def keeps(self) -> Column:
        """True where no rule rejects: CASE WHEN rule 1 THEN false WHEN rule 2 ... ELSE true."""
        verdict = None
        for rule in self.rules:
            holds = _all(c.on_values() for c in rule)
            verdict = F.when(holds, False) if verdict is None else verdict.when(holds, False)
        return F.lit(True) if verdict is None else verdict.otherwise(True)

    def __str__(self) -> str:
        return "\n".join("reject if " + " and ".join(map(str, r)) for r in self.rules) + "\nkeep otherwise"


def _all(conditions) -> Column:
    out = F.lit(True)
    for c in conditions:
        out = out & c
    return out


def learn(stats: DataFrame, labels: DataFrame, label_col: str = "quality", id_col: str = "doc_id", settings: Settings = Settings()) -> DecisionList:
    """A decision list for rejecting rows with label 0. The driver sees counts per feature and bin only."""
    s = settings
    y = labels.where(F.col(id_col).isNotNull() & F.col(label_col).isin(0, 1)).groupBy(F.col(id_col).alias("id")).agg(F.max(label_col).alias("y"))
    rows = stats.withColumnRenamed(id_col, "id").join(y, "id").select("id", (F.col("y") == 0).alias("bad"), *(F.expr(e).cast("double").alias(f) for f, e in FEATURES.items()))
    rows = staged(rows, "labelled")
    levels = [i / s.bins for i in range(1, s.bins)]
    # cuts from both classes: quantiles of all rows and of the bad ones
    quantiles = rows.agg(
        *(F.array_distinct(F.concat(F.percentile_approx(f, levels), F.coalesce(F.percentile_approx(F.when(F.col("bad"), F.col(f)), levels), F.array().cast("array<double>")))).alias(f) for f in FEATURES)
    ).first()
    cuts = {f: sorted(quantiles[f] or []) for f in FEATURES}
    bin_of = lambda f: F.size(F.filter(F.array(*map(F.lit, cuts[f])), lambda t: F.col(f) > t)) if cuts[f] else F.lit(0)
    binned = staged(rows.select("bad", (F.pmod(F.xxhash64("id", F.lit("prune")), F.lit(3)) == 0).alias("prune"), *(bin_of(f).alias(f) for f in FEATURES)), "binned")
    long = lambda df: df.select("bad", F.explode(F.array(*(F.struct(F.lit(f).alias("f"), F.col(f).alias("b")) for f in FEATURES))).alias("x"))
    rules: list[list[Condition]] = []
    left = binned
    while len(rules) < s.max_rules:
        rule: list[Condition] = []
        while len(rule) < s.max_conditions:
            here = left.where(~F.col("prune")).where(_all(c.on_bins() for c in rule))
            counts = long(here).groupBy("x.f", "x.b").agg(F.count_if("bad").alias("p"), F.count_if(~F.col("bad")).alias("n")).collect()
            best = _best_condition(counts, cuts)
            if best is None:
                break
            rule.append(best)
        if not rule:
            break
        prefixes = [_all(c.on_bins() for c in rule[: k + 1]) for k in range(len(rule))]
        got = left.agg(
            *(F.count_if(p & F.col("bad") & F.col("prune")).alias(f"p{k}") for k, p in enumerate(prefixes)),
            *(F.count_if(p & ~F.col("bad") & F.col("prune")).alias(f"n{k}") for k, p in enumerate(prefixes)),
            *(F.count_if(p & F.col("bad")).alias(f"P{k}") for k, p in enumerate(prefixes)),
            *(F.count_if(p & ~F.col("bad")).alias(f"N{k}") for k, p in enumerate(prefixes)),
        ).first()
        k = max(range(len(rule)), key=lambda k: ((got[f"p{k}"] - got[f"n{k}"]) / max(1, got[f"p{k}"] + got[f"n{k}"]), got[f"p{k}"], -k))
        right, wrong = got[f"P{k}"], got[f"N{k}"]
        if right < s.min_covered or right < s.min_precision * (right + wrong):
            break
        rule = rule[: k + 1]
        rules.append(rule)
        left = left.where(~_all(c.on_bins() for c in rule))
    return DecisionList(rules)


def _best_condition(counts, cuts: dict[str, list[float]]) -> Condition | None:
    """The condition of largest information gain, from label counts per feature and bin."""
    by: dict[str, dict[int, tuple[int, int]]] = {}
    for r in counts:
        by.setdefault(r["f"], {})[r["b"]] = (r["p"], r["n"])
    best, gain = None, 1e-9
    for f in sorted(by):
        p_all, n_all = (sum(x[i] for x in by[f].values()) for i in (0, 1))
        if not p_all or not n_all:
            return None
        base, p, n = math.log2(p_all / (p_all + n_all)), 0, 0
        for b in range(len(cuts[f])):
            p, n = p + by[f].get(b, (0, 0))[0], n + by[f].get(b, (0, 0))[1]
            for above, x, y in ((True, p_all - p, n_all - n), (False, p, n)):
                if x and (g := x * (math.log2(x / (x + y)) - base)) > gain:
                    best, gain = Condition(f, above, cuts[f][b], b + 1), g
    return best


def base_failed() -> Column:
    return (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))


def judge(docs: DataFrame, labels: DataFrame, label_col: str = "quality", id_col: str = "doc_id", settings: Settings = Settings()) -> DataFrame:
    """(id_col, the base statistics, base_failed, kept): kept is false where base_failed, else the list's verdict."""
    stats = staged(statistics(docs, id_col), "statistics")
    verdict = learn(stats.where(~base_failed()), labels, label_col, id_col, settings).keeps()
    return stats.select(
        id_col, "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", base_failed().alias("base_failed"), (~base_failed() & verdict).alias("kept")
    )
