"""Quality rules: text statistics and a decision list learned from labels.

All statistics are Spark expressions. A decision list is learned by sequential
covering: a rule, a conjunction of thresholds, is grown on two thirds of the
labelled rows by the condition with the best information gain, cut back on the
other third, kept if it is right there, and the rows it covers are taken away
before the next one. The list becomes ordered WHEN branches, and the first rule
that holds names the reason a text is rejected.

Rules are learned for two classes of rejected texts: bad ones (quality 0) and
toxic ones (toxic 1). For the second, the words that mark toxic labelled texts
are found first, and their number and share in a text are statistics, too.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Labelled rows that rules are learned from, at most.
LABELLED = 20_000
MAX_RULES = 20
MAX_CONDITIONS = 4
#: Thresholds tried for each statistic.
CUTS = 128
#: A rule must be right for this share of what it covers of the rows held back.
PRECISION = 0.9
#: Rows of the bad class that a rule must cover to be kept.
SUPPORT = 3

#: Words that mark toxic texts, at most, and how many toxic texts must have one, in as many contexts: a number and a share.
MAX_MARKS = 256
MARK_TEXTS = 5
MARK_SHARE = 0.01
#: Least logarithm of how much higher the odds of such a word are in toxic texts.
MARK_ODDS = 3.0

MIN_WORDS = 50
REPEAT_SHARE = 50

SPACES = r"[\x20\x09-\x0D]+"
_TRIM = " \t\n\x0b\x0c\r"
#: Statistics that rules may use; each is a share or a mean, or a count of words.
STATISTICS = (
    "n_words", "mean_word", "symbol_share", "repeat_share", "dup_line_share", "upper_share", "digit_share", "distinct_share",
)
#: Statistics that rules for toxic texts may use as well.
MARKED = ("n_marks", "mark_share")


def plain_words(text: Column) -> Column:
    """Runs of letters and digits, in lower case."""
    return F.regexp_extract_all(F.lower(text), F.lit(r"([\p{L}\p{M}\p{N}]+)"))


def statistics(docs: DataFrame, keep: list[str], marks: list[str] | None = None) -> DataFrame:
    """Columns ``keep`` and the statistics of ``text``; a null text has no words.

    ``marks``: words whose number and share are wanted as well.

    Equal three-word windows are found by sorting 64-bit values that hold the
    position in the low bits, as many as the text needs, and a hash above them.
    """
    kept = [F.col(f"`{c}`") for c in keep]
    step = docs.select(*kept, F.coalesce(F.col("text"), F.lit("")).alias("_t"))
    step = step.withColumn("_bare", F.trim(F.col("_t"), F.lit(_TRIM)))
    step = step.withColumn(
        "_w", F.when(F.col("_bare") != "", F.split("_bare", SPACES)).otherwise(F.array().cast("array<string>"))
    )
    lines = F.filter(F.split("_t", "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    count = lambda pattern: F.length(F.regexp_replace("_bare", pattern, "")).cast("long")
    step = step.select(
        *kept,
        "_w",
        F.size("_w").cast("long").alias("n_words"),
        F.length(F.array_join("_w", "")).cast("long").alias("word_chars"),
        count(r"[^#*$%&|<>]+").alias("n_symbols"),
        count(r"\P{Lu}+").alias("_upper"),
        count(r"[^0-9]+").alias("_digits"),
        F.size(F.array_distinct("_w")).alias("_distinct"),
        lines.alias("_lines"),
        (F.size(F.filter(plain_words(F.col("_bare")), lambda x: x.isin(marks))) if marks else F.lit(0))
        .cast("long")
        .alias("n_marks"),
    )
    step = step.withColumn("n_dup_lines", (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long"))
    step = step.withColumn("_n_lines", F.size("_lines")).drop("_lines")

    step = step.withColumn("_mask", F.expr("shiftleft(1L, cast(length(bin(n_words)) as int)) - 1L"))
    at = F.when(F.col("n_words") > 2, F.sequence(F.lit(0), (F.col("n_words") - 3).cast("int"))).otherwise(
        F.array().cast("array<int>")
    )
    window = lambda i: F.xxhash64(F.get("_w", i), F.get("_w", i + 1), F.get("_w", i + 2))
    high = lambda x: x.bitwiseAND(F.bitwise_not(F.col("_mask")))
    step = step.withColumn("_at", at)
    step = step.withColumn("_h", F.sort_array(F.transform("_at", lambda i: high(window(i)).bitwiseOR(i.cast("long")))))
    step = step.drop("_w", "_at")
    again = F.filter(
        "_h",
        lambda x, i: F.coalesce(high(x) == high(F.get("_h", i + 1)), F.lit(False))
        | ((i > 0) & F.coalesce(high(x) == high(F.get("_h", F.greatest(i - 1, F.lit(0)))), F.lit(False))),
    )
    step = step.withColumn("_again", again).drop("_h")
    step = step.withColumn("_places", F.sort_array(F.transform("_again", lambda x: x.bitwiseAND(F.col("_mask")))))
    step = step.drop("_again", "_mask")
    # Windows cover three words each; one that begins sooner after another adds only the distance.
    gaps = F.transform(
        "_places", lambda x, i: F.coalesce(F.least(F.lit(3).cast("long"), F.get("_places", i + 1) - x), F.lit(3).cast("long"))
    )
    repeated = F.aggregate(gaps, F.lit(0).cast("long"), lambda total, x: total + x)
    # The always true test of a row id keeps later filters above this step; moved below it, they
    # would put the whole search inside a lambda and run it once per word.
    step = step.withColumn(
        "n_repeat_words", F.when(F.monotonically_increasing_id() >= 0, repeated).otherwise(0)
    ).drop("_places")
    share = lambda a, b: F.when(F.col(b) > 0, F.col(a) / F.col(b)).otherwise(0.0)
    return step.select(
        *kept,
        "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        share("word_chars", "n_words").alias("mean_word"),
        share("n_symbols", "word_chars").alias("symbol_share"),
        share("n_repeat_words", "n_words").alias("repeat_share"),
        share("n_dup_lines", "_n_lines").alias("dup_line_share"),
        share("_upper", "word_chars").alias("upper_share"),
        share("_digits", "word_chars").alias("digit_share"),
        share("_distinct", "n_words").alias("distinct_share"),
        *(["n_marks", share("n_marks", "n_words").alias("mark_share")] if marks else []),
    )


def base_failed() -> Column:
    """Too short, or more than half of the words in repeated windows."""
    return (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > REPEAT_SHARE * F.col("n_words"))


@dataclass(frozen=True)
class Condition:
    statistic: str
    above: bool
    cut: float

    def holds(self, table: dict[str, np.ndarray]) -> np.ndarray:
        x = table[self.statistic]
        return x > self.cut if self.above else x <= self.cut

    def column(self) -> Column:
        x = F.col(self.statistic)
        return x > F.lit(self.cut) if self.above else x <= F.lit(self.cut)

    def __str__(self) -> str:
        return f"{self.statistic} {'>' if self.above else '<='} {self.cut:.6g}"


Rule = tuple[Condition, ...]


def _covers(rule: Rule, table: dict[str, np.ndarray], rows: np.ndarray) -> np.ndarray:
    out = rows.copy()
    for condition in rule:
        out &= condition.holds(table)
    return out


def _grow(table: dict[str, np.ndarray], bad: np.ndarray, rows: np.ndarray) -> Rule:
    """Add the condition with the best gain until no good row is covered or nothing gains."""
    rule: Rule = ()
    inside = rows
    for _ in range(MAX_CONDITIONS):
        p0, n0 = (inside & bad).sum(), (inside & ~bad).sum()
        if n0 == 0 or p0 == 0:
            break
        start = np.log2(p0 / (p0 + n0))
        best, gain = None, 1e-9
        for name, x in table.items():
            own, is_bad = x[inside], bad[inside]
            cuts = np.unique(np.quantile(own, np.linspace(0, 1, CUTS), method="lower"))
            for cut in cuts:
                high = own > cut
                for above in (True, False):
                    held = high if above else ~high
                    p, n = (held & is_bad).sum(), (held & ~is_bad).sum()
                    if p and p + n < len(own) and (more := p * (np.log2(p / (p + n)) - start)) > gain:
                        best, gain = Condition(name, above, float(cut)), more
        if best is None:
            break
        own = table[best.statistic][inside]
        # Halfway to the next value: rows between the classes go to the nearer one.
        best = Condition(best.statistic, best.above, float((best.cut + own[own > best.cut].min()) / 2))
        rule += (best,)
        inside = inside & best.holds(table)
    return rule


def _prune(rule: Rule, table: dict[str, np.ndarray], bad: np.ndarray, rows: np.ndarray) -> Rule:
    """The shortest beginning of the rule that is best on the rows held back."""
    worth = []
    for size in range(1, len(rule) + 1):
        hit = _covers(rule[:size], table, rows)
        p, n = (hit & bad).sum(), (hit & ~bad).sum()
        worth.append((p - n) / (p + n) if p + n else -1.0)
    return rule[: int(np.argmax(worth)) + 1]


def learn(table: dict[str, np.ndarray], bad: np.ndarray, seed: int = 0) -> list[Rule]:
    """An ordered list of rules for the bad rows; empty where one class is missing."""
    n = len(bad)
    if not bad.any() or bad.all():
        return []
    held_back = np.zeros(n, bool)
    shuffled = np.random.default_rng(seed).permutation(n)
    for kind in (True, False):  # a third of either class
        own = shuffled[bad[shuffled] == kind]
        held_back[own[: len(own) // 3]] = True
    left, rules = np.ones(n, bool), []
    while len(rules) < MAX_RULES and (left & bad & ~held_back).sum() >= SUPPORT:
        rule = _grow(table, bad, left & ~held_back)
        if not rule:
            break
        rule = _prune(rule, table, bad, left & held_back)
        hit, both = _covers(rule, table, left & held_back), _covers(rule, table, left)
        p, every = (hit & bad).sum(), hit.sum()
        if every == 0 or p / every < PRECISION or (both & bad).sum() < SUPPORT:
            break
        rules.append(rule)
        left &= ~both
    return rules


def labelled_statistics(docs: DataFrame, labels: DataFrame, limit: int = LABELLED) -> tuple[dict, np.ndarray]:
    """Statistics and badness (quality 0) of at most ``limit`` labelled texts that the base lets through."""
    joined = _labelled(docs, labels, "quality", limit).limit(limit)
    found = statistics(joined, ["_label"]).filter(~base_failed()).select("_label", *STATISTICS).toPandas()
    return {c: found[c].to_numpy(float) for c in STATISTICS}, found["_label"].to_numpy(float) == 0


def _labelled(docs: DataFrame, labels: DataFrame, label: str, limit: int) -> DataFrame:
    """doc_id, text and _label of the texts of at most ``limit`` labels."""
    some = (
        labels.filter(F.col(label).isNotNull() & F.col("doc_id").isNotNull())
        .select("doc_id", F.col(label).alias("_label"))
        .orderBy(F.xxhash64("doc_id"), "doc_id", "_label")
        .limit(limit)
    )
    # At most ``limit`` rows of two numbers.
    return docs.select("doc_id", "text").join(F.broadcast(some), "doc_id")


def toxic_marks(docs: DataFrame, labels: DataFrame, limit: int = LABELLED) -> list[str]:
    """Words whose odds are far higher in toxic labelled texts than in the others.

    A word must follow as many different words as it must have texts, so that
    copies of one toxic text do not make marks of all their words.
    """
    joined = _labelled(docs, labels, "toxic", limit).select((F.col("_label") == 1).alias("_toxic"), plain_words(F.col("text")).alias("_w"))
    texts = {r["_toxic"]: r["n"] for r in joined.groupBy("_toxic").agg(F.count("*").alias("n")).collect()}
    toxic, other = texts.get(True, 0), texts.get(False, 0)
    if not toxic or not other:
        return []
    least = max(MARK_TEXTS, MARK_SHARE * toxic)
    counts = (
        joined.select("_toxic", F.explode(F.array_distinct("_w")).alias("word"))
        .groupBy("word")
        .agg(F.count_if("_toxic").alias("a"), F.count_if(~F.col("_toxic")).alias("b"))
        .filter(F.col("a") >= least)
        .withColumn("odds", F.log((F.col("a") + 0.5) * (other - F.col("b") + 0.5) / ((toxic - F.col("a") + 0.5) * (F.col("b") + 0.5))))
        .filter(F.col("odds") > MARK_ODDS)
    )
    rows = counts.orderBy(F.desc("odds"), "word").limit(16 * MAX_MARKS).collect()
    words = [r["word"] for r in rows]
    if not words:
        return []
    pairs = F.transform("_w", lambda x, i: F.struct(x.alias("word"), F.get("_w", i - 1).alias("before")))
    contexts = (
        joined.filter("_toxic")
        .select(F.explode(F.array_distinct(F.filter(pairs, lambda x: x["word"].isin(words)))).alias("pair"))
        .select("pair.*")
        .distinct()
        .groupBy("word")
        .count()
        .filter(F.col("count") >= least)
    )
    spread = {r["word"] for r in contexts.collect()}  # as many as there are words, at most
    return [w for w in words if w in spread][:MAX_MARKS]


def learn_toxic(docs: DataFrame, labels: DataFrame, limit: int = LABELLED) -> tuple[list[str], list[Rule]]:
    """Words that mark toxic texts, and rules for toxic texts (toxic 1) that the base lets through."""
    marks = toxic_marks(docs, labels, limit)
    names = STATISTICS + (MARKED if marks else ())
    joined = _labelled(docs, labels, "toxic", limit)
    # The limit is on numbers: on texts it would bring them all to one task.
    measured = statistics(joined, ["doc_id", "_label"], marks).filter(~base_failed()).select("doc_id", "_label", *names)
    found = measured.limit(limit).toPandas().sort_values(["doc_id", "_label"], kind="stable")
    return marks, learn({c: found[c].to_numpy(float) for c in names}, found["_label"].to_numpy(float) == 1)


def rule_column(rules: list[Rule]) -> Column:
    """Number of the first rule that holds, from 1; null where none does."""
    out = None
    for number, rule in enumerate(rules, 1):
        condition = rule[0].column()
        for more in rule[1:]:
            condition = condition & more.column()
        out = F.when(condition, number) if out is None else out.when(condition, number)
    return F.lit(None).cast("int") if out is None else out.otherwise(F.lit(None)).cast("int")


def judge(docs: DataFrame, rules: list[Rule], keep: list[str], marks: list[str] | None = None) -> DataFrame:
    """Columns ``keep``, the statistics, base_failed, rule (the first that holds) and kept.

    ``marks``: the words that rules on MARKED count.
    An empty or null text has no words and fails the base.
    """
    return (
        statistics(docs, keep, marks)
        .withColumns({"base_failed": base_failed(), "rule": rule_column(rules)})
        .withColumn("kept", ~F.col("base_failed") & F.col("rule").isNull())
    )
