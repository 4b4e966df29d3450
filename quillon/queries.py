"""One query for each operator over the driver's tables, with the SQL that gives the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from quillon.fixtures import Tables, sql, strip_sql
from quillon.functions import scoring as S
from quillon.functions import text as X
from quillon.operators import candidates as C
from quillon.operators import context as P
from quillon.operators import incremental as I
from quillon.operators import masks as M
from quillon.operators import ordinals as O
from quillon.operators import penalties as N
from quillon.operators import ranking as R
from quillon.operators import repeats as A
from quillon.operators import stats as T
from quillon.operators import validators as V
from quillon.functions.model_json import fenced_or_braced, first_to_last_brace, reply_parser, without_fence
from quillon.plans import clients, config, models, stages
from quillon.sources import readers, writers
from quillon.sources.readers import reference_answers, samples_from
from quillon.streaming.incremental import judge_stream

QUERIES: dict[str, Callable] = {}
ORACLES: dict[str, str] = {}


def query(oracle: str | None, *views: str):
    """Registers a function of the tables; oracle: what follows its views' SQL."""

    def add(f: Callable[[Tables], DataFrame]):
        QUERIES[f.__name__] = lambda spark, folder: f(Tables(spark, folder))
        QUERIES[f.__name__].__doc__ = f.__doc__
        if oracle:
            ORACLES[f.__name__] = sql("\n" + oracle, *views)
        return f

    return add


def rounded(*names: str):
    return {c: F.round(c, 6) for c in names}


# --- ranks and pairs

_RANKED = ", ranked as (select sample_id, candidate_id, aggregate_score, row_number() over (partition by sample_id order by aggregate_score desc, _pos) as rank, count(*) over (partition by sample_id) as n, max(aggregate_score) over (partition by sample_id) - min(aggregate_score) over (partition by sample_id) as spread from judge_flat)"


@query(f"{_RANKED} select sample_id, candidate_id, aggregate_score, cast(rank as integer) as rank from ranked", "judge_flat")
def rank_candidates(t):
    return R.rank_candidates(t.judge_flat())


@query(
    f"{_RANKED} select p.sample_id, p.candidate_id as positive, q.candidate_id as negative from ranked p join ranked q on p.sample_id = q.sample_id where p.rank <= 2 and q.rank > q.n - 2 and p.spread >= 100",
    "judge_flat",
)
def pref_pairs(t):
    """The first two against the last two of samples whose scores spread by 100."""
    return R.preference_pairs(R.rank_candidates(t.judge_flat()), 2, 2, 100.0)


@query(f"{_RANKED} select sample_id, candidate_id, aggregate_score, cast(rank as integer) as rank, rank <= 2 as is_top from ranked where rank <= 2 or rank > n - 2", "judge_flat")
def top_bottom_k(t):
    ranked = R.rank_candidates(t.judge_flat())
    top, bottom = R.top_bottom_k(ranked, 2, 2)
    return top.withColumn("is_top", F.lit(True)).unionByName(bottom.filter("rank > 2").withColumn("is_top", F.lit(False)))


@query(f"{_RANKED} select sample_id, candidate_id, aggregate_score, cast(rank as integer) as rank from ranked where spread >= 200", "judge_flat")
def min_score_diff(t):
    return R.wide_enough(R.rank_candidates(t.judge_flat()), 200.0)


@query(
    """, p as (select sample_id, row_number() over (partition by sample_id order by ground_score desc, _pos) = row_number() over (partition by sample_id order by structure_score desc, _pos) as same from judge_flat)
    select sample_id, bool_and(same) as agrees from p group by sample_id""",
    "judge_flat",
)
def rank_agreement(t):
    return R.rank_agreement(t.judge_flat())


@query(
    """, p as (select sample_id, aggregate_score, row_number() over (partition by sample_id order by ground_score desc, _pos) = row_number() over (partition by sample_id order by structure_score desc, _pos) as same from judge_flat)
    select sample_id, max(aggregate_score) - min(aggregate_score) as spread, max(aggregate_score) - min(aggregate_score) >= 200 and bool_and(same) as is_rank_trustworthy from p group by sample_id""",
    "judge_flat",
)
def rank_trustworthy(t):
    j = t.judge_flat()
    return R.trustworthy(j, 200.0, R.rank_agreement(j))


@query(
    f"""{_RANKED}, pairs as (select p.sample_id, p.candidate_id as positive, q.candidate_id as negative from ranked p join ranked q on p.sample_id = q.sample_id where p.rank <= 1 and q.rank > q.n - 1),
    c as (select sample_id, candidate_id, model_name as response, aggregate_score from judge_flat)
    select x.sample_id, x.positive, x.negative, a.response as positive_response, a.aggregate_score as positive_score, b.response as negative_response, b.aggregate_score as negative_score, s.query as question, length(s.last_query) as context_length
    from pairs x join c a on x.sample_id = a.sample_id and x.positive = a.candidate_id join c b on x.sample_id = b.sample_id and x.negative = b.candidate_id join samples s on x.sample_id = s.sample_id""".replace(", ranked as", ",\nranked as", 1),
    "samples",
    "judge_flat",
)
def rich_pairs(t):
    j = t.judge_flat()
    samples = t.samples().select("sample_id", F.col("last_query").alias("context"), F.col("query").alias("question"))
    out = R.rich_pairs(R.preference_pairs(R.rank_candidates(j)), j.withColumn("response", F.col("model_name")), samples)
    return out.withColumn("context_length", F.length("context").cast("long")).drop("context")


@query("select sample_id, candidate_id, cast(row_number() over (partition by sample_id order by total_score_20 > 10 desc, case when total_score_20 > 10 then 0 else total_score_20 end desc, _pos) as bigint) as place from judge_flat", "judge_flat")
def sort_results(t):
    """Each sample's results in display order: what is no number first. Here scores over 10 stand for those."""
    one = t.judge_flat().withColumn("shown", F.when(F.col("total_score_20") > 10, F.lit("n/a")).otherwise(F.col("total_score_20").cast("string")))
    ordered = R.sort_results(one, "shown").select("sample_id", "candidate_id", "shown", "_pos")
    place = F.row_number().over(W.partitionBy("sample_id").orderBy(F.desc_nulls_first(F.col("shown").try_cast("double")), "_pos"))
    return ordered.select("sample_id", "candidate_id", place.cast("long").alias("place"))


# --- statistics


@query("select 'events/' || model_name as model, count(*) as count, round(avg(aggregate_score), 6) as mean, round(stddev_pop(aggregate_score), 6) as std, min(aggregate_score) as min, max(aggregate_score) as max from judge_flat group by model_name", "judge_flat")
def model_stats(t):
    return T.model_stats(t.judge_flat()).withColumns(rounded("mean", "std"))


@query("select 'events/' || model_name as model, round(median(aggregate_score), 6) as median from judge_flat group by model_name", "judge_flat")
def score_median(t):
    return T.score_medians(t.judge_flat()).withColumns(rounded("median"))


@query("select model_name, count(*) as count, round(avg(length(response)), 6) as avg_length, min(length(response)) as min_length, max(length(response)) as max_length from (select model_name, coalesce(response, '') as response from candidates) group by model_name", "candidates")
def length_stats(t):
    return T.length_stats(t.candidates()).withColumns(rounded("avg_length"))


@query(", e as (select sample_id, count(*) as n from judge_flat group by sample_id) select min(n) as min_candidates, max(n) as max_candidates, round(avg(n), 6) as avg_candidates from e", "judge_flat")
def candidates_per_sample(t):
    return T.candidates_per_sample(t.judge_flat()).withColumns(rounded("avg_candidates"))


@query(
    """, b as (select min(aggregate_score) as lo, max(aggregate_score) as hi from judge_flat)
    select cast(least(20, floor((aggregate_score - lo) / (hi - lo) * 20) + 1) as bigint) as bin, count(*) as n from judge_flat, b group by 1""",
    "judge_flat",
)
def score_histogram(t):
    return T.histogram(t.judge_flat(), "aggregate_score")


@query("select sample_id, candidate_id, (ground_score + structure_score) / 2 as mean_score from judge_flat", "judge_flat")
def mean_score_v1(t):
    return t.judge_flat().select("sample_id", "candidate_id", S.mean_score(F.col("ground_score"), F.col("structure_score")).alias("mean_score"))


@query("select doc_id, cast(doc_id % 6 as double) as check_mean from labels")
def check_mean(t):
    return t.checks().select("doc_id", T.check_mean(F.col("checks")).alias("check_mean"))


@query("select distinct model_name from judge_flat", "judge_flat")
def distinct_models(t):
    return T.distinct_models(t.judge_flat())


# --- nested and flat forms, joins


@query("select sample_id, count(*) as n, string_agg(candidate_id, ',' order by _pos) as candidate_ids from judge_flat group by sample_id", "judge_flat")
def group_by_sample(t):
    grouped = C.group_by_sample(t.judge_flat().select("sample_id", "_pos", "candidate_id", "aggregate_score"))
    return grouped.select("sample_id", F.size("results").cast("long").alias("n"), F.array_join(F.transform("results", lambda r: r["candidate_id"]), ",").alias("candidate_ids"))


@query("select sample_id, candidate_id, aggregate_score, cast(row_number() over (partition by sample_id order by _pos) - 1 as integer) as _pos from judge_flat", "judge_flat")
def flatten_grouped(t):
    return C.flatten_grouped(C.group_by_sample(t.judge_flat().select("sample_id", "_pos", "candidate_id", "aggregate_score")))


@query("select sample_id, candidate_id, md5(coalesce(case when _pos % 3 = 0 then null else response end, '')) as response_md5 from candidates", "candidates")
def flatten_candidates(t):
    own = t.candidates().withColumn("response", F.when(F.col("_pos") % 3 != 0, F.col("response")))
    generated = C.group_by_sample(own, "candidates")
    return C.flatten_candidates(generated).select("sample_id", "candidate_id", F.md5("response").alias("response_md5"))


@query(", l as (select sample_id, max(_pos) as _pos from judge_flat group by sample_id) select j.sample_id, j.candidate_id, j.aggregate_score from judge_flat j join l on j.sample_id = l.sample_id and j._pos = l._pos", "judge_flat")
def latest_per_key(t):
    return C.latest_per_key(t.judge_flat(), "sample_id", order="_pos").select("sample_id", "candidate_id", "aggregate_score")


@query(", l as (select sample_id, min(_pos) as _pos from judge_flat group by sample_id) select j.sample_id, j.candidate_id, j.aggregate_score from judge_flat j join l on j.sample_id = l.sample_id and j._pos = l._pos", "judge_flat")
def first_per_key(t):
    return C.first_per_key(t.judge_flat(), "sample_id", order="_pos").select("sample_id", "candidate_id", "aggregate_score")


@query(
    """, runs as (select sample_id, _pos // 1000 as run, max(_pos // 1000) over (partition by sample_id) as last, candidate_id from judge_flat)
    select sample_id, candidate_id from runs where run = last""",
    "judge_flat",
)
def rehydrate_candidates(t):
    """Candidates of each sample's latest row; rows are runs of a thousand events."""
    own = t.judge_flat().select("sample_id", F.expr("_pos div 1000").alias("_ordinal"), "_pos", "candidate_id", "model_type", "model_name", F.lit("x").alias("response"))
    generated = own.groupBy("sample_id", "_ordinal").agg(F.array_sort(F.collect_list(F.struct("_pos", "candidate_id", "model_type", "model_name", "response"))).alias("candidates"))
    flat = generated.withColumn("candidates", F.transform("candidates", lambda c: F.struct(*[c[k].alias(k) for k in ("candidate_id", "model_type", "model_name", "response")])))
    return C.rehydrate_candidates(flat).select("sample_id", "candidate_id")


@query("select j.sample_id, j.candidate_id, s.query from judge_flat j join samples s on j.sample_id = s.sample_id", "judge_flat", "samples")
def candidates_to_sample(t):
    return C.with_samples(t.judge_flat(), t.samples().select("sample_id", "query")).select("sample_id", "candidate_id", "query")


def _contexts(t):
    return t.samples().select("sample_id", F.col("last_query").alias("context"), F.col("query").alias("question"))


_GROUPED = ", g as (select sample_id, count(*) as n, string_agg(candidate_id, ',' order by _pos) as ids from judge_flat group by sample_id)"


def _shown(generated):
    return generated.select("sample_id", "context", "question", F.size("candidates").cast("long").alias("n"), F.array_join(F.transform("candidates", lambda c: c["candidate_id"]), ",").alias("ids"))


@query(f"{_GROUPED} select s.sample_id, coalesce(last_query, '') as context, query as question, n, ids from samples s join g on s.sample_id = g.sample_id", "judge_flat", "samples")
def generated_rows(t):
    return _shown(C.generated_rows(t.judge_flat().select("sample_id", "_pos", "candidate_id"), _contexts(t)))


@query(f"{_GROUPED} select s.sample_id, coalesce(last_query, '') as context, query as question, coalesce(n, 0) as n, coalesce(ids, '') as ids from samples s left join g on s.sample_id = g.sample_id", "judge_flat", "samples")
def generated_rows_all(t):
    return _shown(C.generated_rows(t.judge_flat().select("sample_id", "_pos", "candidate_id"), _contexts(t), keep_empty=True))


@query(
    f"""select sample_id, candidate_id, md5(response) as response_md5 from candidates where {strip_sql("coalesce(response, '')")} <> ''""", "candidates"
)
def response_index(t):
    """Scores with the response of their candidate."""
    own = t.candidates()
    scores = own.select("sample_id", F.concat("candidate_id", F.lit("#"), F.col("_pos").cast("string")).alias("candidate_id"))
    texts = own.select("sample_id", F.concat("candidate_id", F.lit("#"), F.col("_pos").cast("string")).alias("candidate_id"), "response")
    return C.with_valid_text(scores, texts).select("sample_id", F.substring_index("candidate_id", "#", 1).alias("candidate_id"), F.md5("response").alias("response_md5"))


@query("select 'beside' as place, sample_id, candidate_id, md5(response) as response_md5 from candidates where _pos % 2 = 0 and response is not null union all select 'next', sample_id, candidate_id, md5(response) from candidates where response is not null", "candidates")
def response_sources(t):
    """Responses out of what lies beside the results, where that holds any; else out of the next place."""
    own = t.candidates()
    path = _file(t, "beside", lambda p: writers.write_jsonl(own.filter("_pos % 2 = 0").select("sample_id", "candidate_id", "response"), p))
    read = lambda p: readers.read_jsonl(t.spark, p, "sample_id string, candidate_id string, response string", "skip")
    found = {"beside": C.response_index(read(path), own), "next": C.response_index(read(f"{path}/none"), own)}
    tagged = [x.select(F.lit(k).alias("place"), "sample_id", "candidate_id", F.md5("response").alias("response_md5")) for k, x in found.items()]
    return tagged[0].unionByName(tagged[1])


@query(f"""select sample_id, candidate_id, length(response) as n from candidates where {strip_sql("coalesce(response, '')")} <> ''""", "candidates")
def has_valid_text(t):
    return t.candidates().filter(X.filled("response")).select("sample_id", "candidate_id", F.length("response").cast("long").alias("n"))


@query("select j.sample_id, j.candidate_id, s.last_query as context, s.query as question from judge_flat j left join samples s on j.sample_id = s.sample_id", "judge_flat", "samples")
def context_index(t):
    return C.with_context(t.judge_flat().select("sample_id", "candidate_id"), _contexts(t))


@query("select sample_id, candidate_id, model_name from judge_flat where _pos % 2 = 1", "judge_flat")
def resume_pending(t):
    j = t.judge_flat()
    return I.resume_pending(j, j.filter("_pos % 2 = 0")).select("sample_id", "candidate_id", "model_name")


@query(", m as (select sample_id, count(distinct model_name) as n from judge_flat where aggregate_score > 60 group by sample_id) select sample_id from m where n = (select count(*) from generators)", "judge_flat", "generators")
def completed_samples(t):
    return I.completed_samples(t.judge_flat().filter("aggregate_score > 60"), t.generators())


@query(", m as (select sample_id, count(distinct model_name) as n from judge_flat where aggregate_score > 60 group by sample_id) select distinct sample_id from judge_flat where sample_id not in (select sample_id from m where n = (select count(*) from generators))", "judge_flat", "generators")
def to_generate(t):
    j = t.judge_flat()
    return I.incomplete_samples(j.select("sample_id").distinct(), t.generators(), j.filter("aggregate_score > 60"))


@query(
    """, m as (select sample_id, string_agg(distinct model_name, ',' order by model_name) filter (aggregate_score > 60) as have from judge_flat group by sample_id)
    select sample_id, coalesce(have, '') as have, (select count(*) from generators) - case when have is null then 0 else len(string_split(have, ',')) end as n_missing from m""",
    "judge_flat", "generators",
)
def model_masks(t):
    """Which configured models each user has a candidate of, out of the bits of one aggregation."""
    j = t.judge_flat()
    masks, models_ = M.model_masks(t.generators(), j.filter("aggregate_score > 60").select("sample_id", "model_type", "model_name"), j.select("sample_id").distinct())
    lacks = masks.filter("is_sample").select("sample_id", F.transform(M.missing("have", models_), lambda m: m["model_name"]).alias("lacks"))
    have = F.array_except(F.array(*[F.lit(m) for _, m in models_]), "lacks")
    return lacks.select("sample_id", F.array_join(have, ",").alias("have"), F.size("lacks").cast("long").alias("n_missing"))


_MODELS = ", models as (select distinct model_type, model_name from candidates)"


@query(
    f"""{_MODELS}, ok as (select sample_id, model_type, model_name, bool_and({strip_sql("coalesce(response, '')")} = '') as bad from candidates group by all)
    select s.sample_id, m.model_type, m.model_name from (select distinct sample_id from candidates) s cross join models m left join ok on ok.sample_id = s.sample_id and ok.model_type = m.model_type and ok.model_name = m.model_name where bad is null or bad""",
    "candidates",
)
def repair_plan(t):
    c = t.candidates()
    return I.repair_plan(c.select("sample_id").distinct(), c, c)


@query(
    """, old as (select *, row_number() over (partition by sample_id, model_type, model_name order by _pos) as r from judge_flat), cur as (select * from old where r = 1 and _pos % 2 = 0), new as (select * from old where r = 1 and _pos % 3 = 0)
    select coalesce(c.sample_id, n.sample_id) as sample_id, coalesce(c.model_name, n.model_name) as model_name, coalesce(-n.aggregate_score, c.aggregate_score) as aggregate_score
    from cur c full join new n on c.sample_id = n.sample_id and c.model_name = n.model_name""",
    "judge_flat",
)
def repair_apply(t):
    """Half of the first candidates, updated or completed by a third of them with turned scores."""
    firsts = C.first_per_key(t.judge_flat(), "sample_id", "model_type", "model_name", order="_pos").select("sample_id", "model_type", "model_name", "candidate_id", "aggregate_score", "_pos")
    out = I.repair_apply(firsts.filter("_pos % 2 = 0"), firsts.filter("_pos % 3 = 0").withColumn("aggregate_score", -F.col("aggregate_score")))
    return out.select("sample_id", "model_name", "aggregate_score")


def _manual(t):
    own = t.judge_flat().withColumn("_sample", F.concat("sample_id", F.lit("/"), (F.col("_pos") % 10).cast("string")))
    ranks = F.collect_list(F.struct("candidate_id", F.when(F.col("total_score_20") > 14, F.lit("0")).when(F.col("total_score_20") > 6, F.lit("-1")).otherwise(F.col("total_score_20").cast("string")).alias("manual_score")))
    return own.groupBy(F.col("_sample").alias("sample_id")).agg(ranks.alias("manual_ranks"))


_ZERO = ", m as (select sample_id || '/' || (_pos % 10) as sample_id, case when total_score_20 > 14 then 0 when total_score_20 > 6 then -1 else total_score_20 end as v from judge_flat), z as (select sample_id from m group by sample_id having max(v) <= 0)"


@query(f"{_ZERO} select sample_id from z", "judge_flat")
def all_zero_samples(t):
    return I.all_zero_samples(_manual(t))


@query(f"{_ZERO} select j.candidate_id from judge_flat j where j.sample_id || '/' || (j._pos % 10) in (select sample_id from z)", "judge_flat")
def patch_semi(t):
    raw = t.judge_flat().withColumn("sample_id", F.concat("sample_id", F.lit("/"), (F.col("_pos") % 10).cast("string")))
    return I.patch_rows(raw, I.all_zero_samples(_manual(t))).select("candidate_id")


@query("select g.model_name as judge, sample_id, candidate_id from judge_flat j cross join generators g", "judge_flat", "generators")
def judge_tasks(t):
    return C.tasks(t.judge_flat().select("sample_id", "candidate_id"), t.generators().select(F.col("model_name").alias("judge")))


@query("select sample_id, model_type, model_name from samples s cross join generators g", "samples", "generators")
def generation_tasks(t):
    return C.tasks(t.samples().select("sample_id"), t.generators())


@query(
    """, s as (select sample_id, candidate_id, try_cast(case when _pos % 5 = 0 then 'x' else cast(_pos % 6 as varchar) end as integer) as manual_score from judge_flat where _pos % 2 = 0)
    select j.sample_id, j.candidate_id, s.manual_score from judge_flat j left join s on j.sample_id = s.sample_id and j.candidate_id = s.candidate_id""",
    "judge_flat",
)
def manual_scores_lookup(t):
    j = t.judge_flat()
    text = F.when(F.col("_pos") % 5 == 0, F.lit("x")).otherwise((F.col("_pos") % 6).cast("string"))
    saved = j.filter("_pos % 2 = 0").select("sample_id", "candidate_id", F.lit("f").alias("source_file"), text.alias("manual_score"), F.col("_pos").alias("_ordinal"))
    return I.with_manual_scores(j.select("sample_id", "candidate_id"), saved, "f")


@query("select sample_id, candidate_id, model_name as value from judge_flat where _pos % 4 <> 0 union all select sample_id, candidate_id, 'new' from judge_flat where _pos % 4 = 0", "judge_flat")
def manual_upsert(t):
    j = t.judge_flat().select("sample_id", "candidate_id", F.col("model_name").alias("value"), "_pos")
    return I.manual_upsert(j.drop("_pos"), j.filter("_pos % 4 = 0").drop("_pos").withColumn("value", F.lit("new")), "sample_id", "candidate_id")


@query("select sample_id, model_name, candidate_id from judge_flat", "judge_flat")
def union_candidates(t):
    j = t.judge_flat()
    parts = [j.filter(F.col("_pos") % 3 == i).select("sample_id", "model_name", "candidate_id") for i in range(3)]
    return C.union_candidates(*parts)


@query("select sample_id, candidate_id, cast(_pos % 3 as integer) as repeat_idx from judge_flat", "judge_flat")
def read_repeats(t):
    j = t.judge_flat()
    return A.read_repeats([j.filter(F.col("_pos") % 3 == i).select("sample_id", "candidate_id") for i in range(3)])


@query("select sample_id, candidate_id from judge_flat where _pos < 100", "judge_flat")
def scan_limit(t):
    return C.page(t.judge_flat(), 0, 100, "_pos").select("sample_id", "candidate_id")


@query("select sample_id, candidate_id from judge_flat where _pos >= 40 and _pos < 60", "judge_flat")
def page(t):
    return C.page(t.judge_flat(), 40, 20, "_pos").select("sample_id", "candidate_id")


@query("select candidate_id, aggregate_score from judge_flat where sample_id = '8'", "judge_flat")
def filter_sample(t):
    return C.of_sample(t.judge_flat(), "8").select("candidate_id", "aggregate_score")


@query("select cast(coalesce(case when doc_id % 2 = 0 then doc_id end, doc_id + 1) as varchar) as sample_id from documents")
def row_identity(t):
    own = t("documents").select(F.when(F.col("doc_id") % 2 == 0, F.col("doc_id").cast("string")).alias("sample_id"), F.lit("q").alias("query"), F.col("doc_id").alias("row"))
    return samples_from(own, F.col("row")).select("sample_id")


@query("select sample_id, nullif(concat_ws(',', case when coalesce(a_answer, '') <> '' then 'a_answer' end, case when coalesce(b_answer, '') <> '' then 'b_answer' end), '') as keys from samples", "samples")
def reference_family(t):
    own = t.samples()
    return own.select("sample_id", F.array_join(F.map_keys(reference_answers(own.columns)), ",").alias("keys"))


@query("select sample_id, coalesce(nullif(a_answer, ''), nullif(b_answer, ''), '（无参考答案）') as picked from samples", "samples")
def reference_pick(t):
    own = t.samples()
    refs = reference_answers(own.columns)
    pick = [F.nullif(F.try_element_at(refs, F.lit(k)), F.lit("")) for k in ("a_answer", "b_answer", "answer_phone", "think_phone")]
    return own.select("sample_id", F.coalesce(*pick, F.lit("（无参考答案）")).alias("picked"))


# --- text building

_Q, _LQ, _LA = strip_sql("coalesce(query, '')"), strip_sql("coalesce(last_query, '')"), strip_sql("coalesce(last_answer_phone, '')")
_MARK = "'（无）'"


def _or_mark(x):
    return f"coalesce(nullif({strip_sql(f"coalesce({x}, '')")}, ''), {_MARK})"


_NL = "chr(10)"
_MODULES = f"""'[个人数据]' || {_NL} || {_or_mark("data")} || {_NL} || {_NL} || '[专家建议]' || {_NL} || {_or_mark("suggest")} || {_NL} || {_NL} || '[知识库知识]' || {_NL} || {_or_mark("rag")} || {_NL} || {_NL}
    || '[课程库]' || {_NL} || case when coalesce(service, '') = '' then {_MARK} else {strip_sql("service")} end"""
_CONTEXT = f"""{_MODULES} || {_NL} || {_NL} || '[对话历史]' || {_NL} || case when {_LQ} <> '' or {_LA} <> '' then concat_ws({_NL}, case when coalesce(last_query, '') <> '' then 'user: ' || {_LQ} end,
    case when coalesce(last_answer_phone, '') <> '' then 'assistant: ' || {_LA} end) else {_MARK} end || {_NL} || {_NL} || '[用户提问]' || {_NL} || {_Q}"""


@query(f"select sample_id, {_CONTEXT} as context from samples", "samples")
def context_text(t):
    return t.samples().select("sample_id", P.context_text().alias("context"))


@query(
    f"""select sample_id, md5({_CONTEXT}) as context_md5, query as question, _ordinal as source_row_index, category_level1,
    nullif(concat_ws(' ||| ', case when coalesce(a_answer, '') <> '' then 'a_answer:' || a_answer end, case when coalesce(b_answer, '') <> '' then 'b_answer:' || b_answer end), '') as reference_answer from samples""",
    "samples",
)
def context_samples(t):
    own = t.samples()
    out = P.context_samples(own.withColumn("reference_answers", reference_answers(own.columns)))
    return out.select("sample_id", F.md5("context").alias("context_md5"), "question", "meta.source_row_index", "meta.extra.category_level1", "reference_answer")


_SKIP = "'user: （上一轮问题略）'"


@query(f"select sample_id, concat_ws({_NL}, case when {_LQ} <> '' or {_LA} <> '' then case when {_LQ} <> '' then 'user: ' || {_LQ} else {_SKIP} end end, case when {_LA} <> '' then 'assistant: ' || {_LA} end, 'user: ' || query) as input_data from samples", "samples")
def judge_input_data(t):
    return t.samples().select("sample_id", P.judge_input().alias("input_data"))


@query(f"select sample_id, {_MODULES} as modules from samples", "samples")
def judge_modules_block(t):
    return t.samples().select("sample_id", P.module_sections().alias("modules"))


@query(f"select sample_id, case when {_LA} <> '' then case when {_LQ} <> '' then 'user: ' || {_LQ} else {_SKIP} end || {_NL} || 'assistant: ' || {_LA} else {_MARK} end as history from samples", "samples")
def judge_history(t):
    return t.samples().select("sample_id", P.judge_history().alias("history"))


_DEDUCTION_MODULES = f"""concat_ws({_NL} || {_NL}, '## 模块数据', '[个人数据]' || {_NL} || coalesce(data, ''), '[课程库]' || {_NL} || coalesce(service, ''),
    case when coalesce(rag, '') <> '' or coalesce(suggest, '') <> '' then '[知识库知识]' || {_NL} || concat_ws({_NL}, nullif(rag, ''), nullif(rag, ''), nullif(suggest, '')) end,
    case when coalesce(suggest, '') <> '' then '[专家建议]' || {_NL} || suggest end)"""


@query(f"select sample_id, {_DEDUCTION_MODULES} as modules from samples", "samples")
def deduction_modules(t):
    return t.samples().select("sample_id", P.deduction_modules().alias("modules"))


@query("select sample_id, case when coalesce(query, '') <> '' then 'user: ' || query else '' end as user_input, coalesce('assistant: ' || last_answer_phone, '') as history_input from samples", "samples")
def deduction_inputs(t):
    user, history = P.deduction_inputs()
    return t.samples().select("sample_id", user.alias("user_input"), history.alias("history_input"))


def _section_sql(x: str) -> str:
    """What a section of a built context holds: its text and the blank line behind it; nothing where it is blank."""
    return f"case when {strip_sql(f"coalesce({x}, '')")} not in ('', {_MARK}) then {strip_sql(x)} || {_NL} else '' end"


_HISTORY_SQL = f"""case when {_LQ} <> '' or {_LA} <> '' then concat_ws({_NL}, case when coalesce(last_query, '') <> '' then 'user: ' || {_LQ} end, case when coalesce(last_answer_phone, '') <> '' then 'assistant: ' || {_LA} end) || {_NL} else '' end"""


@query(
    f""", h as (select *, {_HISTORY_SQL} as hist from samples)
    select sample_id, {", ".join(f"{_section_sql(k)} as {k}" for k in ("data", "suggest", "rag", "service"))}, case when contains(hist, 'assistant:') then {strip_sql("replace(hist, 'assistant:', '')")} else hist end as last_answer_phone,
    {_Q} as query from h""",
    "samples",
)
def parse_context(t):
    """All six sections out of built contexts, each with the blank line behind it."""
    return t.samples().select("sample_id", P.parse_context(P.context_text()).alias("p")).select("sample_id", "p.*")


@query(f"""select doc_id, md5(x) as text_md5, length(x) as n from (select doc_id, case when {strip_sql("coalesce(text, '')")} in ('', {_MARK}) then '' else regexp_replace(text, '^\\n+', '') end as x from documents)""")
def parse_long_context(t):
    """Whole documents as the knowledge of a context, read back line by line; empty lines in front are no content."""
    text = F.concat(F.lit(P.HEADERS["rag"] + "\n"), F.coalesce("text", F.lit("")), F.lit("\n" + P.HEADERS["query"]))
    held = P.parse_context(text)["rag"]
    return t("documents").select("doc_id", F.md5(held).alias("text_md5"), F.length(held).cast("long").alias("n"))


@query("select sample_id, replace(replace('Q: {query} / {last}', '{query}', coalesce(query, '') || ' {last}'), '{last}', coalesce(last_query, '')) as prompt from samples", "samples")
def render_prompt_seq(t):
    return t.samples().select("sample_id", P.render_in_sequence("Q: {query} / {last}", {"query": F.concat(X.text_or_empty("query"), F.lit(" {last}")), "last": X.text_or_empty("last_query")}).alias("prompt"))


@query("select sample_id, 'Q: ' || coalesce(query, '') || ' $last / ' || coalesce(last_query, '') || ' $unknown $ 5' as prompt from samples", "samples")
def render_prompt_once(t):
    return t.samples().select("sample_id", P.render_once("Q: $query / ${last} $unknown $$ 5", {"query": F.concat(X.text_or_empty("query"), F.lit(" $last")), "last": X.text_or_empty("last_query")}).alias("prompt"))


@query("select sample_id, candidate_id from candidates", "candidates")
def candidate_id(t):
    return t.candidates().select("sample_id", "candidate_id")


@query("select _pos, case when model_name in ('src1', 'src2') then ltrim(substr(x, 19), ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) else x end as answer from (select _pos, model_name, 'a</think>b</think>  ' || coalesce(response, '') as x from candidates)", "candidates")
def strip_reasoning(t):
    text = F.concat(F.lit("a</think>b</think>  "), F.coalesce("response", F.lit("")))
    return t.candidates().select("_pos", X.strip_reasoning(text, F.col("model_name"), ["src1", "src2"]).alias("answer"))


@query(f"select _pos, _pos % 3 = 1 or {strip_sql("coalesce(response, '')")} = '' as is_placeholder from (select _pos, case when _pos % 7 = 0 then null else response end as response from candidates)", "candidates")
def is_placeholder(t):
    """Responses as they are, missing ones, and the stand-in amid white space."""
    text = F.when(F.col("_pos") % 3 == 1, F.lit(f" {X.PLACEHOLDER}\n")).when(F.col("_pos") % 7 == 0, F.lit(None).cast("string")).otherwise(F.col("response"))
    return t.candidates().select("_pos", X.is_placeholder(text).alias("is_placeholder"))


@query("select _pos, '#' || _pos || case when _pos % 2 = 0 then ' | id: ' || _pos when coalesce(response, '') <> '' then ' | question: ' || case when length(response) > 60 then substr(response, 1, 60) || '...' else response end else '' end as title from candidates", "candidates")
def record_title(t):
    own = F.when(F.col("_pos") % 2 == 0, F.col("_pos").cast("string")).otherwise(F.lit(""))
    return t.candidates().select("_pos", X.record_title(F.col("_pos"), {"id": own, "question": F.col("response")}).alias("title"))


@query(
    f"""select conv_id, turn, role as label_1, md5(x) as content_1_md5, case when turn % 2 = 0 and instr(x, ':') = 0 then 'answer_2' else case when turn % 2 = 0 then {strip_sql("split_part(x, ':', 1)")} else 'b' end end as label_2,
    md5(case when turn % 2 = 0 and instr(x, ':') > 0 then {strip_sql("substr(x, instr(x, ':') + 1)")} else x end) as content_2_md5
    from (select conv_id, turn, role, {strip_sql("coalesce(text, '')")} as x from conversations)"""
)
def split_reference(t):
    """Every turn's whole text on both sides of the separator, behind its role, and behind a label or none."""
    x = X.strip(X.text_or_empty("text"))
    own = t("conversations").withColumn("x", x)
    second = F.when(F.col("turn") % 2 == 0, F.col("x")).otherwise(F.concat(F.lit("b: "), F.col("x")))
    parts = X.split_reference(F.concat("role", F.lit(": "), "x", F.lit(" ||| "), second))
    return own.select("conv_id", "turn", *[c for k in (0, 1) for c in (parts[k]["label"].alias(f"label_{k + 1}"), F.md5(parts[k]["content"]).alias(f"content_{k + 1}_md5"))])


@query("select _pos, replace(substr(response, 1, 200), chr(10), ' ') || case when length(response) > 200 then '...' else '' end as preview from candidates", "candidates")
def preview(t):
    return t.candidates().select("_pos", X.preview(F.col("response")).alias("preview"))


# --- findings, penalties, scores


@query("select doc_id, rule_id from checks where hit", "checks")
def hit_checks(t):
    return t.checks().select("doc_id", F.explode(N.hit_checks(F.col("checks"))).alias("c")).select("doc_id", "c.rule_id")


@query("select doc_id, rule_id from checks where doc_id % 6 < 5", "checks")
def non_full_checks(t):
    return t.checks().select("doc_id", F.explode(N.non_full_checks(F.col("checks"))).alias("c")).select("doc_id", "c.rule_id")


_PENALTY_OF_CHECK = "case rule_id when 'illegal_content' then 20.0 when 'THIN_CONTENT' then 5.0 when 'FACT_LOGIC_ISSUE' then 10.0 end"


@query(f"select doc_id, upper(rule_id) as rule_id, cast({_PENALTY_OF_CHECK} as double) as score from checks where hit and rule_id <> 'HALLUCINATION_VALUE'", "checks")
def checks_to_penalties(t):
    return t.checks().select("doc_id", F.explode(N.checks_to_penalties(F.col("checks"))).alias("p")).select("doc_id", "p.rule_id", "p.score")


@query(
    """select event_id, round(case event_id % 6 when 0 then k / 100 when 1 then least(1, k / 50) when 2 then 0.5 when 3 then 0.85 when 4 then 0 else 1 end::double, 6) as confidence
    from (select event_id, cast(json_extract_string(props, '$.k') as double) as k from events)"""
)
def normalize_confidence(t):
    """Shares and numbers out of each event's properties, its type (which is no word of confidence), and words."""
    k = F.get_json_object("props", "$.k")
    forms = (F.concat(k, F.lit("% ")), (k.cast("double") / 50).cast("string"), F.col("event_type"), F.lit(" High "), F.concat(F.lit("-"), k, F.lit("%")), F.concat(F.lit("1"), k, F.lit(".5")))
    return t("events").select("event_id", S.normalize_confidence(F.get(F.array(*forms), (F.col("event_id") % 6).cast("int"))).alias("confidence")).withColumns(rounded("confidence"))


_SNAP = "case when score >= 15 then 20.0 when score >= 7.5 then 10.0 when score >= 4 then 5.0 else 3.0 end::double"


@query(f"select answer, _pos, {_SNAP} as score from penalties", "penalties")
def snap_penalty(t):
    return t.penalties().select("answer", "_pos", S.snap_penalty(F.col("score")).alias("score"))


_KEPT = f""", snapped as (select answer, upper(rule_id) as rule_id, {_SNAP} as score, reason, excerpt, _pos from penalties),
    kept as (select answer, rule_id, max(score) as score, min(_pos) as first_pos from snapped group by answer, rule_id)"""


@query(f"{_KEPT} select answer, rule_id, score, first_pos from kept", "penalties")
def dedup_keep_max(t):
    return N.dedup_keep_max(t.penalties()).select("answer", "rule_id", "score", F.col("_first._pos").alias("first_pos"))


@query(f"{_KEPT}, m as (select answer, rule_id, max(score) as score from (select answer, rule_id, score from kept union all select distinct l_orderkey, 'NO_MARKDOWN', 5.0::double from lineitem) group by all) select answer, count(*) as n, sum(score) as total from m group by answer", "penalties")
def merge_penalties(t):
    """Three lists of penalties joined in order and deduplicated."""
    own = t.penalties()
    extra = own.select("answer").distinct().select("answer", F.lit("no_markdown").alias("rule_id"), F.lit(4.5).alias("score"), F.lit("").alias("reason"), F.lit("").alias("excerpt"), F.lit(0).cast("long").alias("_pos"))
    merged = N.merge_penalties(own.filter("_pos % 2 = 0"), own.filter("_pos % 2 = 1"), extra)
    return N.dedup_keep_max(merged).groupBy("answer").agg(F.count("*").alias("n"), F.sum("score").alias("total"))


_TOTALS = f"{_KEPT}, totals as (select o_orderkey as answer, greatest(0, 20 - coalesce(sum(score), 0))::double as total_score from orders left join kept on o_orderkey = answer group by o_orderkey)"


def _answers(t):
    return t("orders").select(F.col("o_orderkey").alias("answer"))


@query(f"{_TOTALS} select answer, total_score from totals", "penalties")
def total_score(t):
    return N.total_scores(_answers(t), N.dedup_keep_max(t.penalties()))


@query(f"{_TOTALS} select answer, total_score, case when total_score >= 12 then 1 else 0 end as label, round(least(5, greatest(0.1, pow(greatest(0, abs(total_score - 12) - 0.5) / 20, 1.5) * 1.25)), 6) as weight from totals", "penalties")
def label_weight(t):
    return N.label_and_weight(N.total_scores(_answers(t), N.dedup_keep_max(t.penalties()))).withColumns(rounded("weight"))


_GROUND = "('ARITH_ERROR')"


@query(
    f"""{_KEPT} select o_orderkey as answer, greatest(0, 20 - coalesce(sum(score) filter (where rule_id = 'ARITH_ERROR'), 0)) * 5 / 20::double as ground_score, greatest(0, 20 - coalesce(sum(score) filter (where rule_id = 'GRAMMAR'), 0)) * 5 / 20::double as structure_score,
    greatest(0, 20 - coalesce(sum(score), 0))::double as total_score_20, greatest(0, 20 - coalesce(sum(score), 0)) / 20 * 5::double as aggregate_score from orders left join kept on o_orderkey = answer group by o_orderkey""",
    "penalties",
)
def dimension_score(t):
    return N.dimension_scores(_answers(t), N.dedup_keep_max(t.penalties()))


@query("select sample_id, candidate_id, total_score_20 / 20.0::double * 5 as aggregate_score_5 from judge_flat", "judge_flat")
def aggregate_score_5(t):
    return t.judge_flat().select("sample_id", "candidate_id", S.aggregate_score(F.col("total_score_20")).alias("aggregate_score_5"))


@query("select candidate_id, least(1.0, greatest(0.0, (ground_score / 4 + structure_score / 4) / 2)) as confidence from judge_flat", "judge_flat")
def avg_confidence(t):
    return t.judge_flat().select("candidate_id", N.average_confidence(F.col("ground_score") / 4, F.col("structure_score") / 4).alias("confidence"))


@query("select candidate_id, coalesce(total_score_20 >= 12 and _pos % 9 > 1, false) as passes from judge_flat", "judge_flat")
def pass_threshold(t):
    shown = F.when(F.col("_pos") % 9 == 0, F.lit("NaN")).when(F.col("_pos") % 9 == 1, F.lit("n/a")).otherwise(F.col("total_score_20").cast("string"))
    return t.judge_flat().select("candidate_id", S.passes(shown).alias("passes"))


@query("select candidate_id, case when _pos % 9 < 2 or total_score_20 <= 0 then 0 when total_score_20 >= 20 then 5 when total_score_20 >= 16 then 4 when total_score_20 >= 14 then 3 when total_score_20 >= 12 then 2 else 1 end as manual_score from judge_flat", "judge_flat")
def manual_score(t):
    shown = F.when(F.col("_pos") % 9 == 0, F.lit("NaN")).when(F.col("_pos") % 9 == 1, F.lit("n/a")).otherwise(F.col("total_score_20").cast("string"))
    return t.judge_flat().select("candidate_id", S.manual_score(shown).alias("manual_score"))


@query("select candidate_id, case when _pos % 9 = 1 or total_score_20 > 5 then 0 else cast(total_score_20 as integer) end as manual_score from judge_flat", "judge_flat")
def clamp_manual(t):
    shown = F.when(F.col("_pos") % 9 == 1, F.lit("n/a")).otherwise(F.col("total_score_20").cast("string"))
    return t.judge_flat().select("candidate_id", S.clamped_manual(shown).alias("manual_score"))


_MANUAL = "case when total_score_20 <= 0 then 0 when total_score_20 >= 20 then 5 when total_score_20 >= 16 then 4 when total_score_20 >= 14 then 3 when total_score_20 >= 12 then 2 else 1 end"


@query(f"select sample_id, 'f.jsonl' as source_file, count(*) as n, sum({_MANUAL})::bigint as manual_sum from judge_flat where _pos % 50 <> 0 group by sample_id", "judge_flat")
def manual_rank_rows(t):
    """Human-rank rows; items without a candidate_id are left out."""
    own = t.judge_flat().withColumn("candidate_id", F.when(F.col("_pos") % 50 != 0, F.col("candidate_id")))
    judged = C.group_by_sample(own.select("sample_id", "_pos", "candidate_id", "model_name", "model_type", "aggregate_score", "ground_score", "structure_score", "total_score_20"))
    return I.manual_rank_rows(judged, "f.jsonl").select(
        "sample_id", "source_file", F.size("manual_ranks").cast("long").alias("n"), F.aggregate("manual_ranks", F.lit(0).cast("long"), lambda a, r: a + r["manual_score"]).alias("manual_sum")
    )


@query("select sample_id, count(*) as n from judge_flat where _pos % 100 > 0 group by sample_id", "judge_flat")
def valid_manual_record(t):
    own = t.judge_flat().withColumn("candidate_id", F.when(F.col("_pos") % 100 > 0, F.col("candidate_id")))
    judged = C.group_by_sample(own.select("sample_id", "_pos", "candidate_id", "model_name", "model_type", "aggregate_score", "ground_score", "structure_score", "total_score_20"))
    return I.manual_rank_rows(judged, "f").select("sample_id", F.size("manual_ranks").cast("long").alias("n"))


@query("select sample_id, candidate_id, total_score_20 from judge_flat where _pos % 6 <> 0", "judge_flat")
def drop_failed_judge(t):
    """Candidates whose judgement failed (no score) are dropped."""
    return I.drop_failed(t.judge_flat().withColumn("total_score_20", F.when(F.col("_pos") % 6 != 0, F.col("total_score_20")))).select("sample_id", "candidate_id", "total_score_20")


@query("select sample_id, candidate_id from judge_flat j where not exists (select 1 from judge_flat f where f.sample_id is not distinct from j.sample_id and f.model_type is not distinct from j.model_type and f._pos % 40 = 0)", "judge_flat")
def drop_failed_pair(t):
    """Where one judgement of a group failed, none of the group stays."""
    own = t.judge_flat().withColumn("total_score_20", F.when(F.col("_pos") % 40 != 0, F.col("total_score_20")))
    return I.drop_failed_together(own, "sample_id", "model_type").select("sample_id", "candidate_id")


_WORDED = " or ".join(f"contains(lower(answer), '{w}')" for w in N.GRADE_WORDS)
_MARKED = "(contains(answer, '#') or contains(answer, '- ') or contains(answer, '* ') or (contains(answer, '|') and contains(answer, chr(10) || '|-')))"


@query(
    f"""select doc_id, case when doc_id % 2 = 0 then 'GRAMMAR' else concat_ws(',', case when not {_MARKED} then 'NO_MARKDOWN' end, case when not ({_WORDED}) then 'PERSONAL_DATA_ANALYSIS_ISSUE' end) end as rules from graded""",
    "graded",
)
def zero_penalty_guard(t):
    """Every second answer has a penalty already."""
    own = F.struct(F.lit("GRAMMAR").alias("rule_id"), F.lit(3.0).alias("score"), F.lit("").alias("reason"), F.lit("").alias("excerpt"))
    penalties = F.when(F.col("doc_id") % 2 == 0, F.array(own)).otherwise(F.array().cast("array<struct<rule_id: string, score: double, reason: string, excerpt: string>>"))
    guarded = N.zero_penalty_guard(penalties, F.col("answer"), V.is_graded(F.col("parsed")))
    return _graded(t).select("doc_id", F.array_join(F.transform(guarded, lambda p: p["rule_id"]), ",").alias("rules"))


# --- validators

_TARGET = "case when doc_id % 3 = 0 then round(((doc_id % 9) * 60 + 40 + 1440 - 1380 - doc_id % 60) % 1440 / 60.0, 2) else doc_id % 9 + 0.5 end"
_SAID = r"try_cast(regexp_extract(answer, '(?i)(\p{Nd}+(?:\.\p{Nd}+)?)[\s\x0b\x{85}\p{Z}]*(?:h|小时)', 1) as double)"
_DURATION = f"case when {_SAID} is null then 'PERSONAL_DATA_ANALYSIS_ISSUE' when abs({_SAID} - ({_TARGET})) > 0.25 then 'PERSONAL_DATA_MISMATCH' end"
_GRADE = f"case when not ({_WORDED} or (doc_id % 101 >= 70 and contains(lower(answer), 'zeta'))) then 'PERSONAL_DATA_ANALYSIS_ISSUE' end"
_CHART = r"case when doc_id % 2 = 0 and not (regexp_matches(answer, '\n\|[^\n]+\|\n\|[-:\s\x0b|]+\|\n') or contains(answer, '![')) then 'MISSING_CHART_TABLE' end"
_SERVICE = "case when not (contains(lower(answer), lower(source)) and contains(lower(answer), 'the')) then 'MISSING_SERVICE' end"


def _graded(t):
    return t.graded().withColumn("parsed", V.parse_data(F.col("data")))


def _rules(x):
    return F.array_join(F.transform(x, lambda p: p["rule_id"]), ",")


@query(f"select doc_id, coalesce({_DURATION}, '') as rules from graded", "graded")
def validate_sleep_duration(t):
    return _graded(t).select("doc_id", _rules(V.sleep_duration(F.col("answer"), F.col("parsed"))).alias("rules"))


@query(f"select doc_id, coalesce({_GRADE}, '') as rules, case when doc_id % 101 <= 40 then 'poor' when doc_id % 101 <= 70 then 'fair' else 'zeta' end as grade from graded", "graded")
def validate_sleep_grade(t):
    return _graded(t).select("doc_id", _rules(V.sleep_grade(F.col("answer"), F.col("parsed"))).alias("rules"), V.expected_grade(F.col("parsed")).alias("grade"))


@query(f"select doc_id, coalesce({_CHART}, '') as rules from graded", "graded")
def validate_chart(t):
    return _graded(t).select("doc_id", _rules(V.chart(F.col("answer"), V.chart_needed(F.col("parsed")))).alias("rules"))


@query(f"select doc_id, coalesce({_SERVICE}, '') as rules from graded", "graded")
def validate_service(t):
    services = F.from_json(F.col("parsed.services"), "array<string>")
    return _graded(t).select("doc_id", _rules(V.service(F.col("answer"), services)).alias("rules"))


@query(f"select doc_id, concat_ws(',', {_DURATION}, {_GRADE}, {_CHART}, {_SERVICE}) as rules from graded", "graded")
def run_validators(t):
    return _graded(t).select("doc_id", _rules(V.run_validators(F.col("answer"), F.col("parsed"))).alias("rules"))


@query("select doc_id, '23:' || lpad(cast(doc_id % 60 as varchar), 2, '0') as start, doc_id % 101 as score from graded", "graded")
def parse_data_json(t):
    return _graded(t).select("doc_id", F.col("parsed.sleep.start"), F.col("parsed.sleep.score").cast("long").alias("score"))


# --- repeats, two answers


@query(
    """select sample_id, candidate_id, count(*) as n_repeats, min(ground_score) as ground_min_score, array_to_string(list(cast(ground_score as integer) order by repeat_idx), ',') as ground_scores, round(avg(aggregate_score), 6) as aggregate_score,
    round(avg(label), 6) as label_mean, bool_and(passed) as passed, string_agg((repeat_idx + 1) || ': ' || notes, chr(10) order by repeat_idx) as notes, arg_min(model_name, repeat_idx) as model_name from repeats group by sample_id, candidate_id""",
    "repeats",
)
def repeat_aggregate(t):
    out = A.repeat_aggregate(t.repeats()).withColumns(rounded("aggregate_score", "label_mean"))
    lists = F.array_join(F.transform("ground_score", lambda x: x.cast("int").cast("string")), ",")
    return out.withColumn("ground_scores", lists).drop("ground_score", "aggregate_score_list")


@query(
    """select sample_id, candidate_id, arg_min(model_name, repeat_idx) as model_name, arg_min(notes, repeat_idx) as judge_meta,
    string_agg(model_name || ':' || cast(ground_score as integer) || ':' || (repeat_idx + 1), ',' order by repeat_idx) as penalties,
    string_agg(notes || ':' || (repeat_idx + 1), ',' order by repeat_idx) filter (where repeat_idx % 2 = 1) as checks,
    string_agg(cast(cast(ground_score as integer) as varchar), ',' order by repeat_idx) filter (where repeat_idx % 2 = 1) as confidences from repeats group by sample_id, candidate_id""",
    "repeats",
)
def repeat_outputs(t):
    """Penalties and judges' outputs of all runs merged; every second run has an output."""
    number = F.col("ground_score").cast("int").cast("string")
    penalties = F.array(F.struct(F.col("model_name").alias("rule_id"), F.col("ground_score").alias("score"), F.lit("r").alias("reason"), F.lit("").alias("excerpt")))
    output = F.struct(F.array(F.struct(F.col("notes").alias("rule_id"), F.col("passed").alias("hit"))).alias("checks"), number.alias("confidence"))
    own = t.repeats().withColumns({"penalties": penalties, "ground_output": F.when(F.col("repeat_idx") % 2 == 1, output), "judge_meta": F.col("notes")})
    out = A.repeat_aggregate(own.drop("passed", "label", "aggregate_score"))
    each = lambda items, *fields: F.array_join(F.transform(items, lambda x: F.concat_ws(":", *[x[f].cast(c) for f, c in fields])), ",")
    run = ("repeat_idx", "string")
    lines = each("penalties", ("rule_id", "string"), ("score", "int"), run)
    return out.select("sample_id", "candidate_id", "model_name", "judge_meta", lines.alias("penalties"), each("ground_output.checks", ("rule_id", "string"), run).alias("checks"), F.array_join("ground_output.confidence", ",").alias("confidences"))


@query(None)
def repeat_merge(t):
    """States of three sets of runs, each worked out from its runs alone, merged: the same as all runs at once."""
    part = F.when(F.col("repeat_idx") == 0, 0).when(F.col("repeat_idx") <= 3, 1).otherwise(2)
    # The runs are numbered once, and the states of all sets are one table.
    held = writers.stored(A.repeat_state(t.repeats().withColumn("part", part), "part"), "state")
    out = A.finished_repeats(A.merge_states(held.drop("part"))).withColumns(rounded("aggregate_score", "label_mean"))
    lists = F.array_join(F.transform("ground_score", lambda x: x.cast("int").cast("string")), ",")
    return out.withColumn("ground_scores", lists).drop("ground_score", "aggregate_score_list")


ORACLES["repeat_merge"] = ORACLES["repeat_aggregate"]


@query("select conv_id, unnest(['A', 'B']) as which, unnest([answer_a, answer_b]) as answer from answers", "answers")
def long_form(t):
    return C.long_form(t.answers(), "conv_id")


@query("select conv_id, answer_a, answer_b, length(answer_a) as n_a, length(answer_b) as n_b from answers", "answers")
def wide_form(t):
    return C.wide_form(C.long_form(t.answers(), "conv_id").withColumn("n", F.length("answer").cast("long")), "conv_id", "answer", "n")


# --- files: written to the shared folder and read back


def _file(t, name, write):
    path = writers.scratch(t.spark, name)
    write(path)
    return path


@query(
    """select sample_id, query, nullif(data, '') as data, nullif(service, '') as service, nullif(last_query, '') as last_query,
    nullif(concat_ws(',', case when coalesce(a_answer, '') <> '' then 'a_answer' end, case when coalesce(b_answer, '') <> '' then 'b_answer' end), '') as answers from samples""",
    "samples",
)
def scan_samples_csv(t):
    """Samples through a CSV with line breaks and quotes in its cells; empty cells come back as null."""
    own = t.samples().select("sample_id", "query", "data", "service", "last_query", "a_answer", "b_answer")
    path = _file(t, "csv", lambda p: own.write.csv(p, header=True, escape='"', quoteAll=True, emptyValue="", ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False))
    out = readers.scan_samples(t.spark, path)
    return out.select("sample_id", "query", "data", "service", "last_query", F.array_join(F.map_keys("reference_answers"), ",").alias("answers"))


@query("select sample_id, candidate_id, aggregate_score from judge_flat", "judge_flat")
def scan_jsonl_strict(t):
    rows = t.judge_flat().select("sample_id", "candidate_id", "aggregate_score")
    path = _file(t, "jsonl", lambda p: writers.write_jsonl(rows, p))
    return readers.read_jsonl(t.spark, path, "sample_id string, candidate_id string, aggregate_score double", "fail")


def _broken_lines(t):
    """One JSON object an event; every tenth line is cut short."""
    line = F.to_json(F.struct(F.col("candidate_id")))
    text = t.judge_flat().select(F.when(F.col("_pos") % 10 == 0, F.substring(line, 1, 12)).otherwise(line).alias("value"))
    return _file(t, "lines", lambda p: text.write.text(p))


@query("select candidate_id from judge_flat where _pos % 10 <> 0", "judge_flat")
def scan_jsonl_skip_bad(t):
    return readers.read_jsonl(t.spark, _broken_lines(t), "candidate_id string", "skip")


@query("select case when _pos % 10 <> 0 then candidate_id end as candidate_id, _pos % 10 = 0 as is_bad from judge_flat", "judge_flat")
def scan_jsonl_keep_bad(t):
    return readers.read_jsonl(t.spark, _broken_lines(t), "candidate_id string", "keep").select("candidate_id", F.col("_raw").isNotNull().alias("is_bad"))


@query("select sample_id, candidate_id from judge_flat", "judge_flat")
def scan_json_doc(t):
    """Lists of up to 1000 rows, each a JSON document of its own, read as a folder."""
    rows = t.judge_flat().select("sample_id", "candidate_id", F.expr("_pos div 1000").alias("doc"))
    whole = rows.groupBy("doc").agg(F.to_json(F.collect_list(F.struct("sample_id", "candidate_id"))).alias("value"))
    write = lambda p: whole.repartition(F.col("doc")).write.partitionBy("doc").option("maxRecordsPerFile", 1).text(p)
    return readers.read_json_document(t.spark, _file(t, "doc", write), "sample_id string, candidate_id string").select("sample_id", "candidate_id")


@query("select sample_id, candidate_id from judge_flat", "judge_flat")
def append_new(t):
    """Two overlapping appends give every row once."""
    rows = t.judge_flat().select("sample_id", "candidate_id", "_pos")
    path, schema = writers.scratch(t.spark, "append"), "sample_id string, candidate_id string"
    for part in ("_pos % 3 < 2", "_pos % 3 > 0"):
        writers.append_new(rows.filter(part).select("sample_id", "candidate_id"), path, readers.read_jsonl(t.spark, path, schema, "skip"))
    return readers.read_jsonl(t.spark, path, schema)


@query("select candidate_id, cast(_pos % 3 as integer) as repeat_idx from judge_flat where _pos % 3 = 1", "judge_flat")
def write_repeats(t):
    """Runs written by directory; reading one prunes the others."""
    rows = t.judge_flat().select("candidate_id", (F.col("_pos") % 3).cast("int").alias("repeat_idx"))
    path = _file(t, "repeats", lambda p: writers.write_repeats(rows, p))
    return writers.read_all_repeats(t.spark, path, "candidate_id string").filter("repeat_idx = 1")


@query(", s as (select sample_id, max(_pos) as _at from judge_flat group by sample_id) select sample_id, row_number() over (order by _at) as place from s", "judge_flat")
def sort_samples(t):
    j = t.judge_flat()
    order = j.select("sample_id", F.col("_pos").alias("_ordinal"))
    return C.sort_samples(j.select("sample_id").distinct(), order).select("sample_id", (F.col("_place") + 1).alias("place"))


@query("select doc_id, row_number() over (order by source, lang, doc_id) - 1 as place, length(text) as n from (select doc_id, source, lang, text from documents)")
def numbered_rows(t):
    """All documents numbered in an order of three columns, by ranges."""
    own = t("documents").select("doc_id", "source", "lang", F.length("text").cast("long").alias("n"))
    return O.with_ordinals(own, F.asc_nulls_last("source"), F.asc_nulls_last("lang"), "doc_id", name="place").select("doc_id", "place", "n")


@query("select page_id, url from (select page_id, url, row_number() over (order by url desc, page_id) as r from pages) where r > 20 and r <= 60")
def numbered_page(t):
    """A page of the pages by address: what a viewer shows of a table that has an order but no numbers."""
    return C.numbered_page(t("pages").select("page_id", "url"), 20, 40, F.desc_nulls_first("url"), "page_id")


@query(
    "select 'events/' || model_name as model, " + ", ".join(f"round(quantile_cont(aggregate_score, {p / 100}), 6) as p{p}" for p in (0, 25, 50, 75, 100)) + " from judge_flat group by model_name",
    "judge_flat",
)
def score_quantiles(t):
    return T.score_quantiles(t.judge_flat()).withColumns(rounded("p0", "p25", "p50", "p75", "p100"))


# --- replies of models


def _replies(t):
    """Replies in four forms by doc_id, with each document's whole text as a reason: fenced, amid text, plain, and none."""
    check = lambda rule, hit: F.struct(F.lit(rule).alias("rule_id"), F.lit(hit).alias("hit"), F.col("text").alias("reason"))
    share = F.concat((F.col("doc_id") % 90).cast("string"), F.lit("%")).alias("confidence")
    body = F.to_json(F.struct(F.array(check("a", True), check("b", False)).alias("checks"), share))
    form = F.col("doc_id") % 4
    reply = F.when(form == 0, F.concat(F.lit("```json\n"), body, F.lit("\n```"))).when(form == 1, F.concat(F.lit("so: "), body, F.lit(" done"))).when(form == 2, body).otherwise(F.col("text"))
    return t("documents").select("doc_id", reply.alias("reply"))


def _parsed_replies(t, how):
    parsed = _replies(t).select("doc_id", reply_parser(how)("reply").alias("p"))
    hits = F.when(F.col("p.checks").isNotNull(), F.size(F.filter("p.checks", lambda c: c["hit"]))).cast("long")
    reasons = F.md5(F.array_join(F.transform("p.checks", lambda c: c["reason"]), "|"))
    return parsed.select("doc_id", hits.alias("hits"), reasons.alias("reasons_md5"), S.normalize_confidence(F.col("p.confidence")).alias("confidence")).withColumns(rounded("confidence"))


def _parsed_sql(held: str) -> str:
    """hits, reasons and confidence where a form of reply holds an object."""
    return f"""select doc_id, case when {held} then 1::bigint end as hits, case when {held} then md5(text || '|' || text) end as reasons_md5, case when {held} then round((doc_id % 90) / 100.0::double, 6) else 0.5 end as confidence from documents"""


@query(_parsed_sql("doc_id % 4 < 3"))
def extract_json_fenced_or_braced(t):
    return _parsed_replies(t, fenced_or_braced)


@query(_parsed_sql("doc_id % 4 < 3"))
def safe_parse_json(t):
    return _parsed_replies(t, first_to_last_brace)


@query(_parsed_sql("doc_id % 4 in (0, 2)"))
def strip_fence_parse(t):
    return _parsed_replies(t, without_fence)


def _run_inputs(t):
    own = t.samples()
    return own.withColumn("reference_answers", reference_answers(own.columns))


def _made(t, samples=None):
    table = t.generators().withColumn("gen_config", F.lit("{}")).unionByName(t.spark.createDataFrame([("reference", "b_answer", '{"answer_key": "b_answer"}')], "model_type string, model_name string, gen_config string"))
    return stages.generate(_run_inputs(t) if samples is None else samples, table, models.StubClient)


#: What the stub client makes of a prompt, and the candidates that it generates, as SQL.
def _stub_sql(model: str, prompt: str) -> str:
    return f"('0x' || substr(sha1({model} || {_NL} || {prompt}), 1, 8))::bigint"


def _text_sql(x: str) -> str:
    return "'" + x.replace("'", "''").replace("\n", f"' || {_NL} || '") + "'"


def _prompt_sql(template: str, **values: str) -> str:
    out = _text_sql(template)
    for name, value in values.items():
        out = out.replace(f"${name}", f"' || ({value}) || '")
    return out


_MADE = f""", models as (select model_type, model_name from generators union all select 'reference', 'b_answer'),
    prompts as (select *, 'system: {stages.SYSTEM}' || {_NL} || 'user: ' || concat_ws({_NL} || {_NL}, {_CONTEXT}, query, 'Answer the question with the help of this context.') as prompt from samples),
    made as (select *, sample_id || '::' || model_name || '::' || substr(sha1(sample_id || '::' || model_name), 1, 8) as candidate_id,
        case when model_type = 'reference' then coalesce(nullif(b_answer, ''), nullif(a_answer, ''), {_MARK}) else '- answer ' || ({_stub_sql("model_name", "prompt")} % 1000) || ' of ' || model_name end as response,
        cast(dense_rank() over (partition by sample_id order by model_type, model_name) as integer) as _pos from prompts cross join models)"""


@query(f"{_MADE} select sample_id, candidate_id, model_type, model_name, response from made", "samples", "generators")
def generate(t):
    """Candidates of all configured models by the stub client, and the sample's own answers."""
    return _made(t).select("sample_id", "candidate_id", "model_type", "model_name", "response")


def _stub_hash(settings: str = "") -> str:
    return _stub_sql("model_name", f"'{settings}' || {_NL} || prompt" if settings else "prompt")


@query(
    f"""{_MADE} select sample_id, model_name, case model_name when 'click' then '- answer ' || ({_stub_hash('{"temperature": 0}')} % 1000) || ' of click' else '- answer ' || ({_stub_hash('{"temperature": 1}')} % 1000) || ' of ' || model_name end as response
    from made where model_type <> 'reference'""",
    "samples", "generators",
)
def generate_configured(t):
    """Candidates by clients that are made from each model's own settings."""
    names = sorted(r.model_name for r in t.generators().collect())
    own = [config.Model(n, n, settings={"temperature": int(n != "click"), "partitions": 2, "threads": 4}) for n in names]
    return stages.generate(_run_inputs(t), config.model_table(t.spark, tuple(own)), clients.services(own)).select("sample_id", "model_name", "response")


@query(f"{_MADE} select sample_id, model_name, response, 1::bigint as n_asked from made where model_type <> 'reference'", "samples", "generators")
def generate_resumed(t):
    """Two runs over one store, the second over all samples: every prompt was asked once."""
    store = writers.scratch(t.spark, "replies")
    table = t.generators().withColumn("gen_config", F.lit("{}"))
    own = _run_inputs(t)
    stages.generate(own.filter("_ordinal % 2 = 0"), table, models.StubClient, store=store, batch_rows=100, batch_files=4)
    made = stages.generate(own, table, models.StubClient, store=store, batch_rows=100, batch_files=4)
    asked = t.spark.read.schema(models.TASKS).parquet(f"{store}/tasks").groupBy("model", "prompt").agg(F.count("*").alias("n_asked"))
    prompts = stages.prompts(own).join(F.broadcast(table), how="cross").select("sample_id", "model_name", "prompt")
    of = prompts.join(asked, (prompts["model_name"] == asked["model"]) & (prompts["prompt"] == asked["prompt"])).select("sample_id", "model_name", "n_asked")
    return made.select("sample_id", "model_name", "response").join(of, ["sample_id", "model_name"])


@query(
    f"""{_MADE}, each as (select distinct model_name, prompt, {_stub_hash()} % 4 = 0 as bad from made where model_type <> 'reference')
    select model_name as model, count(*) as done, count(*) filter (bad) as failed, count(*) filter (bad) as asked_again from each group by model_name""",
    "samples", "generators",
)
def progress(t):
    """What a run reports while it goes on, summed up over its batches: every fourth prompt fails both times."""
    names = sorted(r.model_name for r in t.generators().collect())
    own = [config.Model(n, n) for n in names]
    known = {n: clients.Service(lambda settings: models.StubClient(fails=4), {}, "stub") for n in names}
    told: list[dict] = []
    stages.generate(_run_inputs(t), config.model_table(t.spark, tuple(own)), known, tries=2, first_delay=0.0, batch_rows=100, batch_files=2, progress=told.append)
    rows = [(m, *(sum(p["models"][m][c] for p in told) for c in models.COUNTS)) for m in names]
    return t.spark.createDataFrame(rows, "model string, " + ", ".join(f"{c} long" for c in models.COUNTS))


@query("select sample_id, candidate_id, max(length(coalesce(response, ''))) as n from candidates group by sample_id, candidate_id having not bool_or(_pos % 10 = 3)", "candidates")
def incremental_judging(t):
    """Candidates that come in as files, some twice, and are judged once; those of every tenth id are in the target before."""
    own = t.candidates().select("sample_id", "candidate_id", "response")
    keys = t.candidates().filter("_pos % 10 = 3").select("sample_id", "candidate_id").distinct()
    one = own.groupBy("sample_id", "candidate_id").agg(F.max(F.length(F.coalesce("response", F.lit("")))).alias("n"))
    source, target, state = (writers.scratch(t.spark, x) for x in ("incoming", "target", "state"))
    writers.write_jsonl(keys.withColumn("n", F.lit(-1).cast("long")), f"{target}/batch=old")
    for part in ("pmod(hash(candidate_id), 3) < 2", "pmod(hash(candidate_id), 3) > 0"):
        writers.write_jsonl(one.filter(part).withColumn("n", F.col("n").cast("long")), source, "append")
    schema = "sample_id string, candidate_id string, n long"
    judge_stream(t.spark, source, schema, lambda df: df, target, schema, state, files_per_batch=2).awaitTermination()
    return readers.read_jsonl(t.spark, target, schema).filter("n >= 0").select("sample_id", "candidate_id", "n")


_TURN = f"case when {_LQ} <> '' then 'user: ' || {_LQ} else {_SKIP} end"
_JUDGE_INPUT = f"concat_ws({_NL}, case when {_LQ} <> '' or {_LA} <> '' then {_TURN} end, case when {_LA} <> '' then 'assistant: ' || {_LA} end, 'user: ' || coalesce(query, ''))"
_JUDGE_HISTORY = f"case when {_LA} <> '' then {_TURN} || {_NL} || 'assistant: ' || {_LA} else {_MARK} end"


def _judged_sql(**values: str) -> str:
    """made with the hash of the stub's reply to both judges' prompts: g and s."""
    g, s = (_stub_sql("'judge'", _prompt_sql(x, **values, answer="coalesce(response, '')")) for x in (stages.GROUND_PROMPT, stages.STRUCTURE_PROMPT))
    return f"{_MADE}, judged as (select *, {g} as g, {s} as s from made)"


def _mean_sql(h: str) -> str:
    return "(" + " + ".join(f"({h} >> {i}) % 6" for i in range(4)) + ") / 4::double"


@query(
    f"""{_judged_sql(modules=_MODULES, history=_JUDGE_HISTORY, input=_JUDGE_INPUT)} select sample_id, candidate_id, model_type, model_name, 'judge' as judge, {_mean_sql("g")} as ground_score, {_mean_sql("s")} as structure_score,
    ({_mean_sql("g")} + {_mean_sql("s")}) / 2 as aggregate_score, cast(null as varchar) as notes, _pos from judged""",
    "samples", "generators",
)
def judge_mean(t):
    """Both judges of the mean scale by the stub client."""
    own = writers.stored(_run_inputs(t), "samples")
    return stages.judge_mean(_made(t, own), own, "judge", models.StubClient).drop("ground_raw", "structure_raw")


_HIT = "list_filter([0, 1, 2, 3], lambda i: ({h} >> i) & 1 = 1 and ({h} >> (i + 4)) & 1 = 1)"
_FOUND = f"""{_judged_sql(modules=_DEDUCTION_MODULES, history="coalesce('assistant: ' || last_answer_phone, '')", input="case when coalesce(query, '') <> '' then 'user: ' || query else '' end")},
    hits as (select *, {_HIT.format(h="g")} as gs, {_HIT.format(h="s")} as ss from judged),
    found as (select *, list_transform(gs || list_filter(ss, lambda i: not list_contains(gs, i)), lambda i: [{{'r': 'REDUNDANT', 'v': 3.0, 'g': 0.0, 'w': 'stub'}}, {{'r': 'THIN_CONTENT', 'v': 5.0, 'g': 0.0, 'w': 'stub'}},
        {{'r': 'FACT_LOGIC_ISSUE', 'v': 10.0, 'g': 10.0, 'w': 'stub'}}, {{'r': 'NUM_COMPARE_ERROR', 'v': 20.0, 'g': 20.0, 'w': 'stub'}}][i + 1]) as hit,
        regexp_matches(response, '#|- |[*] ') or (contains(response, '|') and contains(response, {_NL} || '|-')) as marked from hits),
    kept as (select *, case when len(hit) > 0 or marked then hit else [{{'r': 'NO_MARKDOWN', 'v': 5.0, 'g': 0.0, 'w': 'no Markdown structure'}}] end as p from found),
    sums as (select *, coalesce(list_sum(list_transform(p, lambda x: x.v)), 0)::double as v, coalesce(list_sum(list_transform(p, lambda x: x.g)), 0)::double as gv from kept),
    totals as (select *, greatest(0, 20 - v) as total from sums)"""


@query(
    f"""{_FOUND} select sample_id, candidate_id, model_type, model_name, 'judge' as judge, greatest(0, 20 - gv) / 4 as ground_score, greatest(0, 20 - (v - gv)) / 4 as structure_score, total / 4 as aggregate_score, total as total_score_20,
    case when total >= 12 then 1 else 0 end as label, round(least(5, greatest(0.1, pow(greatest(0, abs(total - 12) - 0.5) / 20, 1.5) * 1.425)), 6) as weight, 0.85::double as confidence, _pos,
    '[' || array_to_string(list_transform(p, lambda x: '{{"rule_id":"' || x.r || '","score":' || x.v || ',"reason":"' || x.w || '","excerpt":""}}'), ',') || ']' as penalties_json_20, 0 as repeat_idx from totals""",
    "samples", "generators",
)
def judge_deductions(t):
    """Validators, both judges of the deduction scale by the stub client, labels and weights."""
    own = writers.stored(_run_inputs(t), "samples")
    return stages.judge_deductions(_made(t, own), own, "judge", models.StubClient).drop("penalties", "ground_output", "structure_output").withColumns(rounded("weight"))


_REPAIRED = f"case when model_type = 'reference' and _pos % 2 = 0 then '{X.PLACEHOLDER}' else response end"


@query(
    f"{_MADE} select sample_id, cast(count(*) as integer) as n, string_agg(model_name, ',' order by _pos) as models, md5(string_agg({_REPAIRED}, {_NL} order by _pos)) as responses_md5 from made group by sample_id",
    "samples", "generators",
)
def repair(t):
    """Missing candidates and placeholders made anew by the stub client; the reference, which is not configured here, stays."""
    made = _made(t).withColumn("response", F.when(F.col("_pos") % 2 == 0, F.lit(X.PLACEHOLDER)).otherwise(F.col("response")))
    table = t.generators().withColumn("gen_config", F.lit("{}"))
    out = stages.repair(_run_inputs(t), table, made, models.StubClient)
    text = lambda c: F.transform("candidates", lambda x: x[c])
    return out.select("sample_id", F.size("candidates").alias("n"), F.array_join(text("model_name"), ",").alias("models"), F.md5(F.array_join(text("response"), "\n")).alias("responses_md5"))
