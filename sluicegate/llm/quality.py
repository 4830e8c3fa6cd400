"""Quality rules as a ledger of failure bits.

Every rule is evaluated once per document. The ledger keeps what was measured and one bit per
failed rule; a policy is a version with a bit mask, so changing the policy, comparing versions
and asking what a rule alone rejects are bitwise operations on the ledger, without the texts.

Defined results: a null text has no words and fails ``few_words``; repeated rows and repeated
ids are judged row by row; a null ``doc_id`` stays null; a very long text is measured whole,
inside its row; other columns of the input are neither read nor returned.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SPACE_RUN = "[\\x20\\x09-\\x0D]+"
WINDOW = 5


@dataclass(frozen=True)
class Rule:
    """A rule: its name, its fixed bit, and when a row of measurements fails it."""

    name: str
    bit: int
    fails: Callable[[], Column]


#: A bit is never given to another rule; retired rules keep theirs.
RULES = (
    Rule("few_words", 0, lambda: F.col("n_words") < 10),
    Rule("repeated_windows", 1, lambda: 100 * F.col("n_repeat_words") > 20 * F.col("n_words")),
    Rule("symbols", 2, lambda: 100 * F.col("n_symbols") > 10 * F.col("word_chars")),
    Rule("repeated_lines", 3, lambda: 2 * F.col("n_dup_lines") > F.col("n_lines")),
    Rule("long_words", 4, lambda: F.col("word_chars") > 40 * F.col("n_words")),
)
BASE = ("few_words", "repeated_windows")

#: Versions of the policy: the rules that reject.
POLICIES = {
    1: BASE,
    2: (*BASE, "symbols", "repeated_lines", "long_words"),
}
CURRENT = 2


def mask(names) -> int:
    """Bits of the named rules."""
    bits = {r.name: 1 << r.bit for r in RULES}
    return sum(bits[name] for name in set(names))


def measure(docs: DataFrame) -> DataFrame:
    """doc_id and the measurements of each text, one row per row of ``docs``."""
    text = F.coalesce("text", F.lit(""))
    words = docs.select(
        "doc_id",
        text.alias("text"),
        F.array_remove(F.split(text, SPACE_RUN), "").alias("words"),
    )
    at = lambda i: F.get("words", i)
    counted = words.select(
        "doc_id",
        F.size("words").cast("long").alias("n_words"),
        F.length(F.array_join("words", "")).cast("long").alias("word_chars"),
        (F.length("text") - F.length(F.regexp_replace("text", "[#*$%&|<>]", ""))).cast("long").alias("n_symbols"),
        F.filter(F.split("text", "\n"), lambda line: line.rlike("[^\\x20\\x09-\\x0D]")).alias("lines"),
        F.when(
            F.size("words") >= WINDOW,
            F.transform(
                F.sequence(F.lit(0), F.size("words") - WINDOW),
                lambda i: F.xxhash64(*(at(i + k) for k in range(WINDOW))),
            ),
        ).alias("windows"),
    )
    kept = ["doc_id", "n_words", "word_chars", "n_symbols"]
    lines = counted.select(
        *kept,
        F.size("lines").cast("long").alias("n_lines"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.when(
            F.size(F.array_distinct("windows")) < F.size("windows"),
            F.sort_array(F.transform("windows", lambda x, i: F.struct(x.alias("name"), i.alias("at")))),
        ).alias("sorted"),
    )
    kept += ["n_lines", "n_dup_lines"]
    near = lambda j: F.get("sorted", j)["name"]
    repeated = lines.select(
        *kept,
        F.filter(
            F.transform(
                "sorted",
                lambda e, j: F.when(
                    (e["name"] == F.coalesce(near(j - 1), F.bitwise_not(e["name"])))
                    | (e["name"] == F.coalesce(near(j + 1), F.bitwise_not(e["name"]))),
                    e["at"],
                ),
            ),
            lambda i: i.isNotNull(),
        ).alias("repeated"),
    )
    covered = F.aggregate(
        F.sort_array("repeated"),
        F.struct(F.lit(0).cast("long").alias("n"), F.lit(-WINDOW).alias("last")),
        lambda a, i: F.struct(
            (a["n"] + F.least(F.lit(WINDOW), i - a["last"])).cast("long").alias("n"), i.alias("last")
        ),
        lambda a: a["n"],
    )
    return repeated.select(*kept, F.coalesce(covered, F.lit(0)).cast("long").alias("n_repeat_words"))


def rule_ledger(docs: DataFrame, rules=RULES) -> DataFrame:
    """The measurements of every document and ``failed``, a bit for each rule it fails."""
    failed = F.lit(0).cast("long")
    for rule in rules:
        failed = failed.bitwiseOR(F.when(rule.fails(), F.lit(1 << rule.bit)).otherwise(F.lit(0)).cast("long"))
    return measure(docs).withColumn("failed", failed)


def apply_policy(ledger: DataFrame, version: int = CURRENT) -> DataFrame:
    """The ledger with ``kept``: no rule of that version of the policy failed."""
    return ledger.withColumn("kept", F.col("failed").bitwiseAND(F.lit(mask(POLICIES[version])).cast("long")) == 0)


def ablation(ledger: DataFrame, version: int = CURRENT, rules=RULES) -> DataFrame:
    """Per rule of a policy: documents that fail it, and those that only it rejects.

    The ledger is first counted by its bits, which leaves one row per pattern of failures.
    """
    policy = mask(POLICIES[version])
    table = ledger.sparkSession.createDataFrame(
        [(r.name, 1 << r.bit) for r in rules if policy >> r.bit & 1], "rule string, bit long"
    )
    patterns = ledger.groupBy(F.col("failed").bitwiseAND(F.lit(policy).cast("long")).alias("failed")).agg(
        F.count(F.lit(1)).alias("n")
    )
    exploded = patterns.withColumn(
        "bit", F.explode(F.array(*(F.lit(1 << r.bit).cast("long") for r in rules if policy >> r.bit & 1)))
    )
    counts = exploded.groupBy("bit").agg(
        F.sum(F.when(F.col("failed").bitwiseAND(F.col("bit")) != 0, F.col("n")).otherwise(0)).alias("fails"),
        F.sum(F.when(F.col("failed") == F.col("bit"), F.col("n")).otherwise(0)).alias("fails_alone"),
        F.sum(F.when(F.col("failed").bitwiseAND(F.bitwise_not(F.col("bit"))) == 0, F.col("n")).otherwise(0)).alias("kept_without"),
    )
    zero = F.lit(0).cast("long")
    return table.join(F.broadcast(counts), "bit", "left").select(
        "rule", *(F.coalesce(c, zero).alias(c) for c in ("fails", "fails_alone", "kept_without"))
    )


def keep_documents(docs: DataFrame, version: int = CURRENT) -> DataFrame:
    """The rows of ``docs``, all columns, that a version of the policy keeps.

    The rules are evaluated on the row itself, so nothing is joined or shuffled.
    """
    inner = [f"_in_{i}" for i in range(len(docs.columns))]
    carried = docs.toDF(*inner)
    place = {c.lower(): i for i, c in enumerate(docs.columns)}
    row = F.struct(*(F.col(inner[i]).alias(f"c{i}") for i in range(len(inner))))
    ledger = rule_ledger(carried.select(row.alias("doc_id"), F.col(inner[place["text"]]).alias("text")))
    judged = apply_policy(ledger, version)
    # Above a generator the filter is not pushed down, where it would evaluate the rules again.
    kept = judged.select("doc_id", F.explode(F.array(F.struct("kept"))).alias("verdict")).where("verdict.kept")
    return kept.select(*(F.col(f"doc_id.c{i}").alias(c) for i, c in enumerate(docs.columns)))
