"""Operator 3: quality rules as a short-circuit cascade.

Features of each text are DataFrame expressions. Rules are conditions that reject a document. The counts among the
features are returned for every document, so no order of rules spares them. On a sample whose features are stored the
cascade therefore measures what each rule costs beyond them, and how many documents it rejects, and orders the rules by
rejections per cost; a document rejected by one rule isn't shown to the next. The order changes the cost only: a document
is kept if no rule rejects it.

Defined results: null and empty texts have no words and fail; rows with equal ids are judged one by one; an empty
table gives an empty result; extra columns don't matter.
"""

from __future__ import annotations

import time
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import Tables, let, text_of, words_of

#: Documents, about, in the sample on which costs and selectivities are estimated, and how often each rule is timed.
SAMPLE_ROWS = 400
TIMES = 2


def repeated_words(words: Column, width: int = 3) -> Column:
    """How many words stand in a window of so many words that the text has twice or more."""

    def covered(grams: Column) -> Column:
        ordered = F.sort_array(F.transform(grams, lambda g, i: F.struct(g.alias("g"), i.alias("i"))))

        def starts(s: Column) -> Column:
            again = F.filter(s, lambda x, i: (x["g"] == F.get(s, i - 1)["g"]) | (x["g"] == F.get(s, i + 1)["g"]))
            return F.sort_array(F.transform(again, lambda x: x["i"]))

        step = lambda acc, p: F.struct((acc["n"] + F.least(F.lit(width), p - acc["at"])).alias("n"), p.alias("at"))
        return F.aggregate(let(ordered, starts), F.struct(F.lit(0).alias("n"), F.lit(-width).alias("at")), step, lambda acc: acc["n"].cast("long"))

    grams = F.transform(F.sequence(F.lit(0), F.size(words) - width), lambda i: F.xxhash64(*[F.get(words, i + k) for k in range(width)]))
    once = lambda g: F.size(g) == F.size(F.array_distinct(g))
    return F.when(F.size(words) < width, F.lit(0).cast("long")).otherwise(let(grams, lambda g: F.when(once(g), F.lit(0).cast("long")).otherwise(covered(g))))


def features(docs: DataFrame) -> DataFrame:
    """doc_id, text, words and the counts that rules use."""
    rows = docs.select("doc_id", text_of().alias("text")).withColumn("words", words_of(F.col("text")))
    lines = F.filter(F.split("text", "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    return rows.select(
        "doc_id",
        "text",
        F.col("words").alias("words"),
        F.size("words").cast("long").alias("n_words"),
        F.length(F.array_join("words", "")).cast("long").alias("word_chars"),
        (F.length("text") - F.length(F.regexp_replace("text", r"[#*$%&|<>]", ""))).cast("long").alias("n_symbols"),
        let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("n_dup_lines"),
        repeated_words(F.col("words")).alias("n_repeat_words"),
    )


@dataclass(frozen=True)
class Rule:
    name: str
    rejects: Column


def default_rules() -> list[Rule]:
    """Rules over features(); each is far outside what prose shows."""
    n = F.col("n_words")
    share = lambda pattern: F.regexp_count("text", F.lit(pattern))
    return [
        Rule("too_short", n < 50),
        Rule("repeats", 100 * F.col("n_repeat_words") > 50 * n),
        Rule("symbols", 10 * F.col("n_symbols") > 3 * n),
        Rule("word_length", (F.col("word_chars") < 2 * n) | (F.col("word_chars") > 15 * n)),
        Rule("duplicate_lines", 2 * F.col("n_dup_lines") > F.size(F.split("text", "\n"))),
        Rule("shouting", 5 * share(r"\p{Lu}{2,}") > 3 * n),
        Rule("no_letters", 2 * share(r"\S*\p{L}\S*") < n),
        Rule("bullets", 10 * share(r"(?m)^\s*[-*•]") > 9 * F.size(F.split("text", "\n"))),
    ]


def sample_of(docs: DataFrame, rows: int) -> DataFrame:
    """(doc_id, text) of about so many documents, those with a small hash: a share of every task's rows, spread over tasks."""
    share = min(1.0, rows / max(1, docs.count()))
    low = F.pmod(F.xxhash64(F.col("doc_id").cast("string"), text_of()), F.lit(1 << 40)) < F.lit(int(share * (1 << 40)) + 1)
    return docs.select("doc_id", text_of().alias("text")).where(low)


def order_rules(docs: DataFrame, rules: list[Rule], sample_rows: int = SAMPLE_ROWS) -> list[tuple[Rule, float, float]]:
    """(rule, seconds, share rejected), in the order of the cascade: most rejections per second first, then by name. One
    job counts the rejections of all rules; then each rule runs TIMES times over the stored features, of which the
    shortest counts, less what a job without a rule takes."""
    sample = Tables(docs.sparkSession, "rules").put(features(sample_of(docs, sample_rows)))
    hits = sample.agg(F.count(F.lit(1)).alias("n"), *[F.count_if(r.rejects).alias(f"r{i}") for i, r in enumerate(rules)]).first()

    def seconds(condition: Column) -> float:
        taken = []
        for _ in range(TIMES):
            began = time.perf_counter()
            sample.agg(F.count_if(condition)).first()
            taken.append(time.perf_counter() - began)
        return min(taken)

    empty = seconds(F.col("doc_id").isNull())
    measured = [(r, max(1e-4, seconds(r.rejects) - empty), hits[f"r{i}"] / max(1, hits["n"])) for i, r in enumerate(rules)]
    return sorted(measured, key=lambda m: (-m[2] / m[1], m[0].name))


def cascade(docs: DataFrame, rules: list[Rule] | None = None) -> DataFrame:
    """features() with rejected_by: the first rule of the measured order that rejects the row, else null. COALESCE
    evaluates a rule only for rows that all rules before it let pass."""
    ordered = order_rules(docs, rules or default_rules())
    return features(docs).withColumn("rejected_by", F.coalesce(*[F.when(r.rejects, F.lit(r.name)) for r, _, _ in ordered]))


def judge(docs: DataFrame, rules: list[Rule] | None = None) -> DataFrame:
    """doc_id, the counts, base_failed and kept."""
    out = cascade(docs, rules)
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", failed.alias("base_failed"), (~failed & F.col("rejected_by").isNull()).alias("kept"), "rejected_by")
