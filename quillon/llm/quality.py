"""Quality rules as a short-circuit cascade, in DataFrame functions only.

Each rule is a Boolean expression that is true when a document breaks it. On a bounded sample the share that every rule rejects
and its mean cost are estimated; the rules are chained in descending order of rejection per cost in one nested conditional, so
that a later rule is evaluated only for rows that all earlier ones let through. The order changes the work, never the verdict.

A rule's cost is measured: each rule alone runs over the sample (and one long text made of it), repeated until its time stands
out from that of a job without a rule. That gives its nanoseconds a unit of what it states to look at (a row, a word, a
character), rounded to a power of two and kept for the session, so that one session orders alike; the cost of a row is that
times the mean units of the sample.

Defined results: a null or empty text has no words (all counts 0) and fails the base rule; repeated rows are judged one by
one; a rule whose value is null does not reject; empty tables give empty results; input columns named like a result column
are replaced, all others stay as they are. Repeated windows are found by hash and then compared word by word, so texts of any
length get exact counts.
"""

from __future__ import annotations

import math
import time
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillon.llm.common import WORD, boxed, discard, materialized, unboxed

#: Rows of the sample from which costs and selectivities are estimated, the share of rows it is drawn from, and the bytes beyond
#: which a text stays out of it. All bounds hold whatever the table's size; only as many partitions are read as fill it.
SAMPLE_ROWS, SAMPLE_SHARE, SAMPLE_BYTES, SEED = 1000, 0.1, 1 << 16, 7
#: Share of rejections that a rule is taken to have at least, so that cheap rules without a hit in the sample stay ordered.
LEAST_REJECTED = 1e-4
#: How often the sample is repeated while a rule is timed (more, until it takes CLEAR seconds beyond a job without a rule), the
#: runs of which the shortest counts (a run of over a second is not repeated), and the characters of the long text.
REPEATS, CLEAR, RUNS, LONG_CHARS = (1, 32, 1024), 0.05, 2, 1 << 17

BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


@dataclass(frozen=True)
class Rule:
    """name, an SQL expression over text, _words (its words) and the base columns that is true for a document to reject, and one
    for the units of work that it does on a row."""

    name: str
    rejects: str
    units: str = "1"


#: Nanoseconds a unit of work, by rule, as measured in this session.
_NANOSECONDS: dict[Rule, float] = {}


#: Production rules. They look at shape only (never at language), with bounds far outside of prose.
RULES = (
    Rule("mean_word_length", "word_chars > 40 * n_words"),
    Rule("symbols", "10 * n_symbols > 3 * word_chars"),
    Rule("duplicate_lines", "n_dup_lines >= 5 and 10 * n_dup_lines > 9 * size(split(text, '\\n'))", "1 + if(n_dup_lines >= 5, length(text), 0)"),
    Rule("repeated_words", "10 * n_repeat_words > 4 * n_words"),
    Rule("few_letters", "2 * regexp_count(text, '\\\\p{L}') < word_chars", "1 + length(text)"),
    Rule("no_letter_words", "2 * size(filter(_words, x -> x rlike '\\\\p{L}')) < n_words", "1 + n_words"),
    Rule("ellipsis_lines", "n_words >= 50 and 2 * size(filter(split(text, '\\n'), x -> endswith(rtrim(x), '...') or endswith(rtrim(x), '…'))) > size(split(text, '\\n'))", "1 + if(n_words >= 50, length(text), 0)"),
    Rule("bullet_lines", "n_words >= 50 and 10 * size(filter(split(text, '\\n'), x -> substring(ltrim(x), 1, 1) in ('-', '*', '•'))) > 9 * size(split(text, '\\n'))", "1 + if(n_words >= 50, length(text), 0)"),
)


def with_features(own: DataFrame) -> DataFrame:
    """own (columns _row and text) with the base columns.

    Repeats: every 3-word window becomes one long, the upper bits of its hash above and its position below; after sorting,
    windows that may be equal stand beside each other. Only these are then sorted by their words, which tells the equal ones.
    That is one sort of longs for each document, and one of the words of its repeats, whatever its length.
    """
    own = own.withColumn("_words", F.regexp_extract_all(F.coalesce("text", F.lit("")), F.lit(WORD), F.lit(0)))
    own = own.withColumn("_n", F.size("_words")).withColumn("_low", F.expr("shiftleft(1L, length(bin(_n)))"))
    own = own.withColumn(
        "_windows",
        F.expr("""case when _n < 4 then cast(array() as array<bigint>) else sort_array(transform(sequence(0, _n - 3),
            i -> (xxhash64(get(_words, i), get(_words, i + 1), get(_words, i + 2)) & -_low) | cast(i as bigint))) end"""),
    )
    own = own.withColumn(
        "_like",
        F.expr("""sort_array(transform(filter(_windows, (x, i) ->
            ifnull((get(_windows, i - 1) & -_low) = (x & -_low), false) or ifnull((get(_windows, i + 1) & -_low) = (x & -_low), false)),
            x -> named_struct('w', concat_ws(' ', get(_words, cast(x & (_low - 1L) as int)), get(_words, cast(x & (_low - 1L) as int) + 1), get(_words, cast(x & (_low - 1L) as int) + 2)),
                'p', x & (_low - 1L))))"""),
    )
    own = own.withColumn(
        "_twice",
        F.expr("""sort_array(transform(filter(_like, (x, i) -> ifnull(get(_like, i - 1).w = x.w, false) or ifnull(get(_like, i + 1).w = x.w, false)), x -> x.p))"""),
    )
    text = F.coalesce("text", F.lit(""))
    own = own.withColumn("_lines", F.filter(F.split(text, "\n"), lambda x: x.rlike(WORD)))
    return own.select(
        "_row",
        "text",
        "_words",
        F.col("_n").cast("long").alias("n_words"),
        F.length(F.translate(text, " \t\n\x0b\f\r", "")).cast("long").alias("word_chars"),
        (F.length(text) - F.length(F.translate(text, "#*$%&|<>", ""))).cast("long").alias("n_symbols"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
        F.expr("aggregate(_twice, named_struct('last', -3L, 'n', 0L), (a, x) -> named_struct('last', x, 'n', a.n + least(3L, x - a.last)), a -> a.n)").alias("n_repeat_words"),
    )


def base_features(docs: DataFrame) -> DataFrame:
    """docs with n_words, word_chars, n_symbols, n_dup_lines and n_repeat_words (all long)."""
    return unboxed(with_features(boxed(docs, "text")), docs.columns, {x: F.col(x) for x in BASE})


def base_failed() -> Column:
    return (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


def sample_of(docs: DataFrame, rows: int = SAMPLE_ROWS) -> DataFrame:
    """A seeded sample of texts as a table of its own; partitions are read one after the other until it is full, without a shuffle."""
    some = docs.select("text").filter(F.octet_length("text") <= SAMPLE_BYTES).sample(SAMPLE_SHARE, SEED).limit(rows).collect()
    some = some or docs.select("text").filter(F.octet_length("text") <= SAMPLE_BYTES).limit(rows).collect()
    return docs.sparkSession.createDataFrame(some, "text string")


def measure(sample: DataFrame, rules) -> None:
    """Notes the nanoseconds a unit of these rules, timed over the sample in one task a job. Nothing is noted of an empty sample."""
    joined = F.array_join(F.collect_list("text"), "\n")
    texts = sample.unionByName(sample.agg(F.substring(joined, 1, LONG_CHARS).alias("text")).filter("text <> ''"))
    featured = materialized(with_features(boxed(texts, "text")).drop("_row"), "rule-costs")
    # Equal columns everywhere, so that the time without a rule is that of reading them.
    units = featured.agg(*[F.sum(F.expr(r.units)).cast("double") for r in rules]).first()
    empty: dict[int, float] = {}

    def seconds(condition: Column, repeats: int) -> float:
        rows = featured.coalesce(1).withColumn("_again", F.explode(F.sequence(F.lit(1), F.lit(repeats))))
        job, took = rows.agg(F.count_if(condition)), []
        for _ in range(RUNS):
            began = time.perf_counter()
            job.collect()
            took.append(time.perf_counter() - began)
            if took[-1] > 1:
                break
        return min(took)

    for rule, total in zip(rules, units):
        if not total:
            continue
        for repeats in REPEATS:
            if repeats not in empty:
                empty[repeats] = seconds(F.length("text") + F.size("_words") < 0, repeats)
            beyond = seconds(F.expr(rule.rejects), repeats) - empty[repeats]
            if beyond >= CLEAR:
                break
        _NANOSECONDS[rule] = 2.0 ** round(math.log2(max(1e9 * beyond / (repeats * total), 0.25)))
    discard(featured)


def order_rules(docs: DataFrame, rules=RULES, sample_rows: int = SAMPLE_ROWS) -> list[tuple[Rule, float, float]]:
    """The rules by descending rejection per cost, each with the share it rejects and its cost a row (nanoseconds) on the sample.

    One job over the sample gives shares and units of all rules; rules not met in this session are timed before. Rules of equal
    figures keep their given order.
    """
    sample = sample_of(docs, sample_rows)
    fresh = [r for r in rules if r not in _NANOSECONDS]
    if fresh:
        measure(sample, fresh)
    featured = with_features(boxed(sample, "text"))
    columns = [F.avg(x) for r in rules for x in (F.coalesce(F.expr(r.rejects), F.lit(False)).cast("int"), F.expr(r.units).cast("double"))]
    got = [x or 0.0 for x in featured.agg(*columns).first()] if rules else []
    figures = [(r, share, units * _NANOSECONDS.get(r, 1.0)) for r, share, units in zip(rules, got[::2], got[1::2])]
    return sorted(figures, key=lambda x: -max(x[1], LEAST_REJECTED) / max(x[2], 1.0))


def cascade(rules: list[Rule]) -> Column:
    """Name of the first rule that rejects, else null: a nested conditional, so later rules see only what is left."""
    out: Column = F.lit(None).cast("string")
    for rule in reversed(rules):
        out = F.when(F.coalesce(F.expr(rule.rejects), F.lit(False)), F.lit(rule.name)).otherwise(out)
    return out


def quality_rules(docs: DataFrame, rules=RULES, sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """docs with the base features, base_failed, kept and failed_rule (the rule that rejected it, `base` for the base rule)."""
    ordered = [r for r, _, _ in order_rules(docs, rules, sample_rows)]
    out = with_features(boxed(docs, "text")).withColumn("_failed", base_failed())
    out = out.withColumn("_rule", F.when(F.col("_failed"), F.lit("base")).otherwise(cascade(ordered)))
    return unboxed(out, docs.columns, {x: F.col(x) for x in BASE} | {"base_failed": F.col("_failed"), "failed_rule": F.col("_rule"), "kept": F.col("_rule").isNull()})
