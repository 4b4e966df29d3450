"""The driver's tables as inputs of this domain. Each view exists twice: as a DataFrame, and as DuckDB SQL for the oracles.

Scores of these tables are not on the scales of real judges (0 to 5, 0 to 20); queries state their thresholds.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from quillon.functions.text import candidate_id, text_or_empty
from quillon.sources.readers import read_parquet

#: How each candidate row's model is typed.
MODEL_TYPES = ("experimental", "open_source", "closed_source", "reference")


class Tables:
    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder

    def __call__(self, name: str) -> DataFrame:
        return read_parquet(self.spark, f"{self.folder}/{name}.parquet")

    def judge_flat(self) -> DataFrame:
        """events as judged candidates of users."""
        k = F.get_json_object("props", "$.k").cast("long")
        return self("events").select(
            F.col("user_id").cast("string").alias("sample_id"),
            F.col("event_id").cast("string").alias("candidate_id"),
            F.lit("events").alias("model_type"),
            F.col("event_type").alias("model_name"),
            F.col("value").alias("aggregate_score"),
            (k % 21).alias("total_score_20"),
            (k % 7).cast("double").alias("ground_score"),
            (F.col("event_id") % 5).cast("double").alias("structure_score"),
            F.col("event_id").alias("_pos"),
        )

    def candidates(self) -> DataFrame:
        """documents as candidates: five neighbouring ids are one sample."""
        sample = F.expr("cast(doc_id div 5 as string)")
        return self("documents").select(
            sample.alias("sample_id"),
            candidate_id(sample, F.col("source")).alias("candidate_id"),
            F.col("lang").alias("model_type"),
            F.col("source").alias("model_name"),
            F.col("text").alias("response"),
            F.col("doc_id").alias("_pos"),
        )

    def samples(self) -> DataFrame:
        """conversations as samples: the last user turn is the question, the latest turns before it the history."""
        turns = self("conversations")
        last = turns.filter("role = 'user'").groupBy("conv_id").agg(F.max("turn").alias("_q"))
        prior = turns.join(last, "conv_id")
        said = lambda role, cond: F.max_by(F.when((F.col("role") == role) & cond, F.col("text")), F.when((F.col("role") == role) & cond, F.col("turn")))
        own = prior.groupBy("conv_id").agg(
            said("user", F.col("turn") == F.col("_q")).alias("query"),
            said("user", F.col("turn") < F.col("_q")).alias("last_query"),
            said("assistant", F.col("turn") < F.col("_q")).alias("last_answer_phone"),
        )
        return own.selectExpr(
            "cast(conv_id as string) as sample_id", "query", "last_query", "last_answer_phone", "conv_id as _ordinal",
            "case conv_id % 4 when 0 then null when 1 then '' when 2 then '　 ' else concat(' d: ', query, ' ') end as data",
            "case conv_id % 3 when 0 then null when 1 then ' \t' else concat('s: ', query) end as suggest",
            "last_query as rag",
            "case conv_id % 3 when 0 then null when 1 then '   ' else concat(' svc ', cast(conv_id as string), '　') end as service",
            "cast(conv_id % 2 as string) as category_level1", "'x' as category_level2", "cast(null as string) as category_level3", "'talk' as domain",
            "last_answer_phone as a_answer", "case when conv_id % 2 = 0 then concat('b', cast(conv_id as string)) end as b_answer",
        )

    def penalties(self) -> DataFrame:
        """lineitem as penalties of orders: rule by line number, raw score by quantity, order by all six columns."""
        rule = F.element_at(F.array(*[F.lit(x) for x in ("arith_error", "Grammar", "UNKNOWN")]), (F.col("l_linenumber") % 3 + 1).cast("int"))
        return self("lineitem").select(
            F.col("l_orderkey").alias("answer"),
            rule.alias("rule_id"),
            F.col("l_quantity").alias("score"),
            F.col("l_returnflag").alias("reason"),
            F.col("l_linestatus").alias("excerpt"),
            (F.col("l_linenumber") * 1_000_000_000_000 + F.col("l_partkey") * 100_000 + F.col("l_suppkey")).alias("_pos"),
        )

    def checks(self) -> DataFrame:
        """labels with documents as judges' findings: toxic ones and those of low quality."""
        check = lambda rule, hit, severity: F.struct(F.lit(rule).alias("rule_id"), hit.alias("hit"), F.lit(severity).alias("severity"), (F.col("doc_id") % 6).cast("double").alias("score"), F.lit("r").alias("reason"), F.lit("").alias("excerpt"))
        found = F.array(check("illegal_content", F.col("toxic") == 1, None), check("THIN_CONTENT", F.col("quality") == 0, "major"), check("FACT_LOGIC_ISSUE", F.col("doc_id") % 3 == 0, "high"), check("HALLUCINATION_VALUE", F.lit(True), "x"))
        return self("labels").join(self("documents").select("doc_id", "text", "lang"), "doc_id").select("doc_id", "text", "lang", found.alias("checks"))

    def repeats(self) -> DataFrame:
        """lineitem as repeated judgements of orders."""
        order = W.partitionBy("l_orderkey").orderBy("l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_shipdate")
        return self("lineitem").select(
            F.lit("o").alias("sample_id"),
            F.col("l_orderkey").cast("string").alias("candidate_id"),
            (F.row_number().over(order) - 1).alias("repeat_idx"),
            F.col("l_quantity").alias("ground_score"),
            (F.col("l_quantity") / 10).alias("aggregate_score"),
            F.when(F.col("l_quantity") >= 25, 1).otherwise(0).alias("label"),
            (F.col("l_linestatus") == "F").alias("passed"),
            F.col("l_returnflag").alias("notes"),
            F.col("l_linestatus").alias("model_name"),
        )

    def generators(self) -> DataFrame:
        """Configured models: the distinct event types."""
        return self("events").select(F.lit("events").alias("model_type"), F.col("event_type").alias("model_name")).distinct()

    def answers(self) -> DataFrame:
        """The first two assistant turns of each conversation as answers A and B."""
        turns = self("conversations").filter("role = 'assistant'").withColumn("_n", F.row_number().over(W.partitionBy("conv_id").orderBy("turn")))
        pick = lambda n: F.max(F.when(F.col("_n") == n, F.col("text")))
        return turns.filter("_n <= 2").groupBy("conv_id").agg(pick(1).alias("answer_a"), pick(2).alias("answer_b")).filter("answer_b is not null")

    def graded(self) -> DataFrame:
        """documents as answers with the data JSON of a sleep module."""
        sleep = F.format_string(
            '{"sleep": {"duration_hours": %s, "start": "23:%02d", "end": "0%d:40", "score": %d, "score_thresholds": {"poor": [0, 40], "fair": [40, 70], "zeta": [70, 100]}}, "require_chart_or_table": %s, "services": ["%s", "the"]}',
            F.when(F.col("doc_id") % 3 == 0, F.lit("null")).otherwise(F.format_string("%.2f", F.col("doc_id") % 9 + F.lit(0.5))), F.col("doc_id") % 60, F.col("doc_id") % 9, F.col("doc_id") % 101,
            F.when(F.col("doc_id") % 2 == 0, F.lit("true")).otherwise(F.lit("false")), F.col("source"),
        )
        answer = F.concat(F.when(F.col("doc_id") % 4 < 2, F.concat(F.lit("About "), (F.col("doc_id") % 9).cast("string"), F.lit(".5 H of sleep. "))).otherwise(F.lit("")), text_or_empty("text"), F.when(F.col("doc_id") % 5 == 0, F.lit("\n|a|b|\n|-|-|\n|1|2|")).otherwise(F.lit("")))
        return self("documents").select("doc_id", "source", answer.alias("answer"), sleep.alias("data"))


def strip_sql(x: str) -> str:
    return f"regexp_replace({x}, '^[\\t-\\r\\x1c-\\x20\\x{{85}}\\p{{Z}}]+|[\\t-\\r\\x1c-\\x20\\x{{85}}\\p{{Z}}]+$', '', 'g')"


#: The views as SQL, to stand behind "with".
SQL = {
    "judge_flat": """judge_flat as (select cast(user_id as varchar) as sample_id, cast(event_id as varchar) as candidate_id, 'events' as model_type, event_type as model_name,
        value as aggregate_score, k % 21 as total_score_20, cast(k % 7 as double) as ground_score, cast(event_id % 5 as double) as structure_score, event_id as _pos
        from (select *, cast(json_extract_string(props, '$.k') as bigint) as k from events))""",
    "candidates": """candidates as (select sample_id, b || '::' || substr(sha1(b), 1, 8) as candidate_id, model_type, model_name, response, _pos
        from (select cast(doc_id // 5 as varchar) as sample_id, cast(doc_id // 5 as varchar) || '::' || source as b, lang as model_type, source as model_name, text as response, doc_id as _pos from documents))""",
    "samples": """last_turn as (select conv_id, max(turn) as q from conversations where role = 'user' group by conv_id),
        said as (select c.conv_id, arg_max(text, turn) filter (where role = 'user' and turn = q) as query, arg_max(text, turn) filter (where role = 'user' and turn < q) as last_query,
            arg_max(text, turn) filter (where role = 'assistant' and turn < q) as last_answer_phone from conversations c join last_turn l on c.conv_id = l.conv_id group by c.conv_id),
        samples as (select cast(conv_id as varchar) as sample_id, query, last_query, last_answer_phone, conv_id as _ordinal,
            case conv_id % 4 when 0 then null when 1 then '' when 2 then '　 ' else ' d: ' || query || ' ' end as data,
            case conv_id % 3 when 0 then null when 1 then ' ' || chr(9) else 's: ' || query end as suggest, last_query as rag,
            case conv_id % 3 when 0 then null when 1 then '   ' else ' svc ' || conv_id || '　' end as service,
            cast(conv_id % 2 as varchar) as category_level1, last_answer_phone as a_answer, case when conv_id % 2 = 0 then 'b' || conv_id end as b_answer from said)""",
    "penalties": """penalties as (select l_orderkey as answer, ['arith_error', 'Grammar', 'UNKNOWN'][l_linenumber % 3 + 1] as rule_id, l_quantity as score, l_returnflag as reason, l_linestatus as excerpt,
        l_linenumber * 1000000000000 + l_partkey * 100000 + l_suppkey as _pos from lineitem)""",
    "checks": """checks as (select d.doc_id, d.text, d.lang, unnest([
            {'rule_id': 'illegal_content', 'hit': toxic = 1, 'severity': null}, {'rule_id': 'THIN_CONTENT', 'hit': quality = 0, 'severity': 'major'},
            {'rule_id': 'FACT_LOGIC_ISSUE', 'hit': d.doc_id % 3 = 0, 'severity': 'high'}, {'rule_id': 'HALLUCINATION_VALUE', 'hit': true, 'severity': 'x'}], recursive := true)
        from labels l join documents d on l.doc_id = d.doc_id)""",
    "repeats": """repeats as (select 'o' as sample_id, cast(l_orderkey as varchar) as candidate_id, row_number() over (partition by l_orderkey order by l_linenumber, l_partkey, l_suppkey, l_quantity, l_shipdate) - 1 as repeat_idx,
        l_quantity as ground_score, l_quantity / 10 as aggregate_score, case when l_quantity >= 25 then 1 else 0 end as label, l_linestatus = 'F' as passed, l_returnflag as notes, l_linestatus as model_name from lineitem)""",
    "generators": "generators as (select distinct 'events' as model_type, event_type as model_name from events)",
    "answers": """turns as (select *, row_number() over (partition by conv_id order by turn) as n from conversations where role = 'assistant'),
        answers as (select conv_id, max(text) filter (where n = 1) as answer_a, max(text) filter (where n = 2) as answer_b from turns where n <= 2 group by conv_id having max(text) filter (where n = 2) is not null)""",
    "graded": """graded as (select doc_id, source, case when doc_id % 4 < 2 then 'About ' || (doc_id % 9) || '.5 H of sleep. ' else '' end || coalesce(text, '') || case when doc_id % 5 = 0 then chr(10) || '|a|b|' || chr(10) || '|-|-|' || chr(10) || '|1|2|' else '' end as answer from documents)""",
}


def sql(query: str, *views: str) -> str:
    return "with " + ",\n".join(SQL[v] for v in views) + query if views else query
