import math
import random
import time

import pytest
from pyspark.sql import functions as F

from quillon.functions import scoring as S
from quillon.functions import text as X
from quillon.functions.model_json import fenced_or_braced, first_to_last_brace, reply_parser, without_fence
from quillon.operators import context as P
from quillon.operators import penalties as N
from quillon.operators import validators as V


def values(spark, kind, items, expression):
    df = spark.createDataFrame([(i, x) for i, x in enumerate(items)], f"i int, x {kind}")
    return [r.v for r in df.select("i", expression(F.col("x")).alias("v")).orderBy("i").collect()]


def test_penalties_snap_to_steps(spark):
    items = ["-1", "0", "3.9", "4", "7.4", "7.5", "14.9", "15", "100", "nan", "x", None]
    assert values(spark, "string", items, S.snap_penalty) == [3, 3, 3, 5, 5, 10, 10, 20, 20, 20, None, 3]


def test_confidence(spark):
    items = ["85%", "high", " Very Low ", "1.0", "nan", None, "", "certain", "x%", "-3", "250%", "0.4", "nan%"]
    assert values(spark, "string", items, S.normalize_confidence) == [0.85, 0.85, 0.1, 1.0, 1.0, 0.5, 0.5, 0.98, 0.5, 0.0, 1.0, 0.4, 1.0]


def test_manual_scores(spark):
    items = ["0", "-1", "nan", "x", None, "11.99", "12", "13.9", "14", "16", "19.9", "20", "25"]
    assert values(spark, "string", items, S.manual_score) == [0, 0, 0, 0, 0, 1, 2, 2, 3, 4, 4, 5, 5]
    assert values(spark, "string", ["3", "6", "-1", "x", None], S.clamped_manual) == [3, 0, 0, 0, 0]
    assert values(spark, "string", ["12", "11.9", "nan", None], S.passes) == [True, False, False, False]


def test_weights(spark):
    got = values(spark, "double", [0.0, 2.0, 5.0, 7.0, 10.0, 12.0, 15.0, 17.0, 20.0], lambda x: S.weight(x, F.lit(0.5)))
    assert [round(x, 6) for x in got] == [0.545019, 0.409214, 0.231598, 0.133409, 0.1, 0.1, 0.1, 0.133409, 0.28705]


def test_every_rule_has_its_deduction(spark):
    rows = [(r, s) for r in (*S.GROUND, *S.STRUCTURE, "OTHER") for s in (None, "5", "Major", "严重")]
    df = spark.createDataFrame(rows, "rule string, severity string").withColumn("score", S.check_score(F.col("rule"), F.col("severity")))
    got = {(r.rule, r.severity): r.score for r in df.collect()}
    assert got["PERSONAL_DATA_ANALYSIS_ISSUE", "5"] == got["PERSONAL_DATA_ANALYSIS_ISSUE", "Major"] == 5 and got["PERSONAL_DATA_ANALYSIS_ISSUE", None] == 3
    assert got["FACT_LOGIC_ISSUE", "严重"] == 10 and got["FACT_LOGIC_ISSUE", "5"] == 5
    assert got["OTHER", None] is None and got["MISSING_SERVICE", None] is None and got["ARITH_ERROR", None] == 20 and got["GRAMMAR", "5"] == 3


def test_strip_is_unicode(spark):
    items = ["　x \x1c", "\n ", None, "a b", "\x85x"]
    assert values(spark, "string", items, X.strip) == [None if x is None else x.strip() for x in items]
    assert values(spark, "string", items, X.filled) == [True, False, False, True, True]


def test_text_helpers(spark):
    assert values(spark, "string", ["a</think>b</think> \n c", "plain"], lambda x: X.strip_reasoning(x, F.lit("m"), ["m"])) == ["c", "plain"]
    assert values(spark, "string", ["a</think>b"], lambda x: X.strip_reasoning(x, F.lit("n"), ["m"])) == ["a</think>b"]
    assert values(spark, "string", ["# x", "a - b", "a|b", "|\n|-", "x"], X.has_markdown) == [True, True, False, True, False]
    assert values(spark, "string", [None], lambda x: X.candidate_id(F.lit("1"), F.lit("m"), F.lit(2)))[0].startswith("1::m#2::")
    assert [None if v is None else [(s.label, s.content) for s in v] for v in values(spark, "string", ["a: x:y ||| plain", "none", ": q ||| b:1 ||| c"], X.split_reference)] == [[("a", "x:y"), ("answer_2", "plain")], None, [("answer_1", "q"), ("b", "1 ||| c")]]


def test_json_out_of_replies(spark):
    good = '{"checks": [{"rule_id": "a", "hit": "false"}]}'
    assert fenced_or_braced(f"so:\n```json\n{good}\n``` done") == fenced_or_braced(f"x {good} y }}") == fenced_or_braced(good) == first_to_last_brace(f"x {good} y") == without_fence(f"```json\n{good}\n```")
    assert fenced_or_braced('{"a": "}"} tail') is None and first_to_last_brace('{"a": "}"} tail') == {"a": "}"}
    assert fenced_or_braced("") is None and first_to_last_brace("no } { json") is None and without_fence("{'a': 1}") is None
    got = values(spark, "string", [good, "none", None, '{"confidence": true}', '{"checks": [{"score": "4", "rule_id": 7}, 3], "confidence": "85%"}'], reply_parser(fenced_or_braced))
    assert got[0].checks[0].hit is True and got[1].checks is None and got[2].checks is None
    assert got[3].checks == [] and got[3].confidence == "1.0" and got[4].checks[0].score == 4.0 and got[4].checks[0].rule_id == "7" and len(got[4].checks) == 1


def sample(spark, **columns):
    base = dict(query="q", last_query=None, data=None, suggest=None, rag=None, service=None, last_answer_phone=None) | columns
    return spark.createDataFrame([tuple(base.values())], ", ".join(f"{k} string" for k in base))


def one(df, expression):
    return df.select(expression.alias("v")).first()["v"]


def test_context_quirks(spark):
    blank = sample(spark, service="  ", last_query=" ", last_answer_phone="a ")
    text = one(blank, P.context_text())
    assert "[课程库]\n\n\n[对话历史]\nuser: \nassistant: a\n\n[用户提问]\nq" in text
    none = one(sample(spark), P.context_text())
    assert none.count(X.NONE_MARK) == 5 and none.endswith("[用户提问]\nq")
    assert one(sample(spark, last_query="x"), P.judge_history()) == X.NONE_MARK
    assert one(sample(spark, last_query="x"), P.judge_input()) == "user: x\nuser: q"
    assert one(sample(spark, last_answer_phone="y"), P.judge_input()) == f"{P.SKIPPED_TURN}\nassistant: y\nuser: q"
    assert one(sample(spark, rag="K", suggest="E"), P.deduction_modules()).count("K") == 2


def test_contexts_parse_back(spark):
    df = sample(spark, data="d1\nd2", suggest=None, rag="k", service="s", last_query="lq", last_answer_phone="la", query="the question")
    got = one(df, P.parse_context(P.context_text()))
    assert (got["data"].rstrip("\n"), got.suggest, got.rag.rstrip("\n"), got.service.rstrip("\n"), got.query) == ("d1\nd2", "", "k", "s", "the question")
    assert "assistant:" not in got.last_answer_phone and got.last_answer_phone.startswith("user: lq")
    odd = spark.createDataFrame([("before\n[用户提问] now [课程库]\nmore",)], "c string")
    assert one(odd, P.parse_context(F.col("c"))).service == "[用户提问] now\nmore"


def slow_sections(context):
    """Sections line by line, with a state."""
    out, at = dict.fromkeys(P.HEADERS, ""), None
    for line in context.split("\n"):
        opened = next((k for k, h in P.HEADERS.items() if h in line), None)
        if opened:
            at, out[opened] = opened, line.strip().replace(P.HEADERS[opened], "").strip()
        elif at:
            out[at] = f"{out[at]}\n{line}" if out[at] else line
    out = {k: "" if v.strip() == X.NONE_MARK else v for k, v in out.items()}
    if "assistant:" in out["last_answer_phone"]:
        out["last_answer_phone"] = out["last_answer_phone"].replace("assistant:", "").strip()
    return tuple(out.values())


def test_sections_equal_a_walk_over_lines(spark):
    """Random lines: headers alone, amid text, twice in a line, opened again, blank lines, marks and no header at all."""
    rng = random.Random(8)
    heads = list(P.HEADERS.values())
    pool = [*heads, *heads, "", "", " ", X.NONE_MARK, "user: a", "assistant: b assistant: c", "text", *(f"x {h} y" for h in heads), heads[0] + heads[3]]
    contexts = ["\n".join(rng.choice(pool) for _ in range(rng.randrange(1, 14))) for _ in range(300)] + ["", "\n\n"]
    got = values(spark, "string", contexts, P.parse_context)
    assert [tuple(r) for r in got] == [slow_sections(c) for c in contexts]


def test_a_long_context_takes_linear_time(spark):
    """One section of many lines: ten times the lines take about ten times as long, not a hundred times."""

    def seconds(n):
        df = spark.range(1).select(F.concat(F.lit(P.HEADERS["rag"] + "\n"), F.repeat(F.lit("some words of a line\n"), n), F.lit(P.HEADERS["query"] + "\nq")).alias("c"))
        own = df.select(P.parse_context(F.col("c")).alias("p")).select(F.length("p.rag").alias("n"), "p.query")
        began = time.perf_counter()
        r = own.first()
        assert (r.n, r.query) == (21 * n - 1, "q")
        return time.perf_counter() - began

    seconds(100)
    assert seconds(50_000) < 20  # 1 MB


def test_templates(spark):
    df = spark.range(1)
    assert one(df, P.render_once("$a ${b} $c $$ $", {"a": F.lit("$b"), "b": F.lit("2")})) == "$b 2 $c $ $"
    assert one(df, P.render_in_sequence("{a} {b}", {"a": F.lit("{b}"), "b": F.lit("2")})) == "2 2"


@pytest.mark.parametrize(
    "data, answer, rules",
    [
        ('{"sleep": {"duration_hours": 7}}', "slept 7.2h", []),
        ('{"sleep": {"duration_hours": 7}}', "slept 8 小时", ["PERSONAL_DATA_MISMATCH"]),
        ('{"sleep": {"duration_hours": 7}}', "slept well", ["PERSONAL_DATA_ANALYSIS_ISSUE"]),
        ('{"sleep": {"start": "23:10", "end": "06:40", "duration_hours": 0}}', "7.5 hours", []),
        ('{"sleep": {"score": 40, "score_thresholds": {"low": [0, 40], "high": [40, 100]}}}', "it was LOW", []),
        ('{"sleep": {"score": 40, "score_thresholds": {"low": [0, 40], "high": [40, 100]}}}', "it was high", ["PERSONAL_DATA_ANALYSIS_ISSUE"]),
        ('{"require_chart_or_table": true}', "text", ["MISSING_CHART_TABLE"]),
        ('{"require_chart_or_table": true}', "x\n|a|b|\n|-|-|\n|1|2|", []),
        ('{"require_chart_or_table": true}', "![i](u)", []),
        ('{"require_chart_or_table": false, "services": ["Yoga", " ", "Run"]}', "yoga", ["MISSING_SERVICE"]),
        ("not json", "text", []),
        (None, "text", []),
        ("[1]", "text", []),
    ],
)
def test_validators(spark, data, answer, rules):
    df = spark.createDataFrame([(data, answer)], "data string, answer string")
    got = df.select(V.run_validators(F.col("answer"), V.parse_data(F.col("data"))).alias("p")).first()["p"]
    assert [p.rule_id for p in got or []] == rules


def test_first_of_equal_penalties_wins(spark):
    rows = [(1, 0, 0, "a", 5.0, "first"), (1, 1, 0, "A", 5.0, "second"), (1, 2, 0, "a", 4.0, "third"), (1, 0, 1, "b", 3.0, "x"), (1, 1, 1, "b", 15.0, "y")]
    df = spark.createDataFrame(rows, "answer int, source int, _pos int, rule_id string, score double, reason string").withColumn("excerpt", F.lit(""))
    got = {r.rule_id: (r.score, r.reason) for r in N.dedup_keep_max(df).collect()}
    assert got == {"A": (5.0, "first"), "B": (20.0, "y")}
    assert math.isclose(N.total_scores(spark.createDataFrame([(1,), (2,)], "answer int"), N.dedup_keep_max(df)).filter("answer = 1").first().total_score, 0.0)


def test_data_json_is_a_filled_object_or_null(spark):
    texts = [None, "", " d: x", "{}", "[1]", "5", "null", '{"a":', "{'a': 1}", '{"a": 1} x', '{"a": 1}, {"b": 2}', '{"a": 1}', ' {"sleep": {"score": 7}} ']
    got = values(spark, "string", texts, V.parse_data)
    assert [x is not None for x in got] == [False] * 11 + [True] * 2
    assert got[-1]["sleep"]["score"] == "7"
