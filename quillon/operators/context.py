"""Contexts and judge inputs built from a sample's columns, and the inverse: sections out of a context."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillon.functions.text import NONE_MARK, bound, filled, joined, strip, stripped_or_mark, text_or_empty

# The headers of a context's sections, in order, and the mark for a skipped turn.
HEADERS = {"data": "[个人数据]", "suggest": "[专家建议]", "rag": "[知识库知识]", "service": "[课程库]", "last_answer_phone": "[对话历史]", "query": "[用户提问]"}
SKIPPED_TURN = "user: （上一轮问题略）"
MODULE_TITLE = "## 模块数据"


def service_text() -> Column:
    """Only a missing service gets the mark; one of white space is empty."""
    return F.when(text_or_empty("service") == "", F.lit(NONE_MARK)).otherwise(strip("service"))


def _said(who: str, column: str) -> Column:
    return F.concat(F.lit(f"{who}: "), strip(F.col(column)))


def history_text() -> Column:
    """Lines of the last turn, if either of its sides is filled; a side that is there is shown even if blank."""
    lines = joined("\n", F.when(text_or_empty("last_query") != "", _said("user", "last_query")), F.when(text_or_empty("last_answer_phone") != "", _said("assistant", "last_answer_phone")))
    return F.when(filled("last_query") | filled("last_answer_phone"), lines).otherwise(NONE_MARK)


def module_sections() -> Column:
    parts = [x for k in ("data", "suggest", "rag") for x in (F.lit(HEADERS[k]), stripped_or_mark(k), F.lit(""))]
    return joined("\n", *parts, F.lit(HEADERS["service"]), service_text())


def context_text() -> Column:
    """Six sections: header, content or mark, blank line."""
    return joined("\n", module_sections(), F.lit(""), F.lit(HEADERS["last_answer_phone"]), history_text(), F.lit(""), F.lit(HEADERS["query"]), strip(text_or_empty("query")))


def reference_text() -> Column:
    """All reference answers that are not empty as 'key:value', in their order; null if there are none."""
    shown = F.filter(F.map_entries("reference_answers"), lambda e: text_or_empty(e["value"]) != "")
    return F.when(F.size("reference_answers") > 0, F.array_join(F.transform(shown, lambda e: F.concat_ws(":", e["key"], e["value"])), " ||| "))


def context_samples(samples: DataFrame) -> DataFrame:
    extra = F.struct("category_level1", "category_level2", "category_level3", "domain")
    meta = F.struct(F.col("_ordinal").alias("source_row_index"), extra.alias("extra"))
    return samples.select("sample_id", context_text().alias("context"), F.col("query").alias("question"), meta.alias("meta"), reference_text().alias("reference_answer"))


def judge_input() -> Column:
    """The last turn, if any of it is filled, and the question."""
    last = filled("last_query") | filled("last_answer_phone")
    return joined(
        "\n",
        F.when(last, F.when(filled("last_query"), _said("user", "last_query")).otherwise(SKIPPED_TURN)),
        F.when(filled("last_answer_phone"), _said("assistant", "last_answer_phone")),
        F.concat(F.lit("user: "), text_or_empty("query")),
    )


def judge_history() -> Column:
    """The last turn, only if its answer is filled."""
    turn = joined("\n", F.when(filled("last_query"), _said("user", "last_query")).otherwise(SKIPPED_TURN), _said("assistant", "last_answer_phone"))
    return F.when(filled("last_answer_phone"), turn).otherwise(NONE_MARK)


def deduction_modules(with_json: Column | None = None) -> Column:
    """Module block of the deduction judges: personal data and courses always, knowledge, advice and parsed data where given."""
    head = lambda k, x: F.concat(F.lit(HEADERS[k] + "\n"), x)
    knowledge = joined("\n", F.when(text_or_empty("rag") != "", F.col("rag")), F.when(text_or_empty("suggest") != "", F.col("suggest")))
    # The knowledge text that accompanies a block is rag and suggest once more.
    whole = joined("\n", F.when(text_or_empty("rag") != "", F.col("rag")), F.when(knowledge != "", knowledge))
    return joined(
        "\n\n",
        F.lit(MODULE_TITLE),
        head("data", text_or_empty("data")),
        head("service", text_or_empty("service")),
        F.when(whole != "", head("rag", whole)),
        F.when(text_or_empty("suggest") != "", head("suggest", F.col("suggest"))),
        F.when(text_or_empty(with_json) != "", F.concat(F.lit("[data JSON]\n"), with_json)) if with_json is not None else F.lit(None).cast("string"),
    )


def deduction_inputs() -> tuple[Column, Column]:
    """(user input, history input) of the deduction judges; empty where there is nothing."""
    user = F.when(text_or_empty("query") != "", F.concat(F.lit("user: "), F.col("query"))).otherwise("")
    history = F.when(F.col("last_answer_phone").isNotNull(), F.concat(F.lit("assistant: "), F.col("last_answer_phone"))).otherwise("")
    return user, history


def render_in_sequence(template: str, values: dict[str, Column]) -> Column:
    """Placeholders {name} replaced one after the other: what is filled in is searched again by those that follow."""
    out = F.lit(template)
    for name, value in values.items():
        out = F.replace(out, F.lit("{" + name + "}"), value)
    return out


def render_once(template: str, values: dict[str, Column]) -> Column:
    """Placeholders $name or ${name} filled in a single pass; unknown names stay, $$ is a dollar."""
    parts: list[Column] = []
    at = 0
    for m in re.finditer(r"\$(?:(\$)|([_a-zA-Z][_a-zA-Z0-9]*)|\{([_a-zA-Z][_a-zA-Z0-9]*)\})", template):
        name = m[2] or m[3]
        parts.append(F.lit(template[at : m.start()]))
        parts.append(F.lit("$") if m[1] else text_or_empty(values[name]) if name in values else F.lit(m[0]))
        at = m.end()
    return F.concat(*parts, F.lit(template[at:]))


def parse_context(context: Column) -> Column:
    """Sections of a context as a struct of strings.

    A line that holds a header (the first header in order wins) opens its section anew and what else it holds is content; a
    section is what stands from its last opening to the next header, without empty lines in front. Each line is looked at once:
    places of headers, then slices between them, joined.
    """
    names = list(HEADERS)

    def opened(line: Column) -> Column:
        out = F.lit(None).cast("int")
        for i in reversed(range(len(names))):
            out = F.when(F.contains(line, F.lit(HEADERS[names[i]])), F.lit(i)).otherwise(out)
        return out

    def section(i: int, lines: Column, marks: Column) -> Column:
        own = F.filter(marks, lambda m: m["section"] == i)
        last = F.try_element_at(own, F.lit(-1))["at"]
        return bound(last, lambda at: F.when(at.isNotNull(), content(i, lines, marks, at)).otherwise(F.lit("")))

    def content(i: int, lines: Column, marks: Column, at: Column) -> Column:
        end = F.coalesce(F.array_min(F.filter(F.transform(marks, lambda m: m["at"]), lambda m: m > at)), F.size(lines))
        rest = strip(F.replace(strip(F.get(lines, at)), F.lit(HEADERS[names[i]]), F.lit("")))
        body = F.concat(F.array(rest), F.slice(lines, at + 2, end - at - 1))
        filled_from = lambda x: F.array_position(F.transform(x, lambda line: line != ""), F.lit(True)).cast("int")
        return bound(body, lambda x: bound(filled_from(x), lambda k: F.when(k > 0, F.array_join(F.slice(x, k, F.size(x)), "\n")).otherwise(F.lit(""))))

    def unmarked(x: Column) -> Column:
        return F.when(strip(x) == NONE_MARK, F.lit("")).otherwise(x)

    def unsaid(x: Column) -> Column:
        x = unmarked(x)
        return F.when(F.contains(x, F.lit("assistant:")), strip(F.replace(x, F.lit("assistant:"), F.lit("")))).otherwise(x)

    def sections(lines: Column) -> Column:
        found = F.filter(F.transform(lines, lambda line, i: F.struct(i.alias("at"), opened(line).alias("section"))), lambda m: m["section"].isNotNull())
        return bound(found, lambda marks: F.struct(*[bound(section(i, lines, marks), unsaid if k == "last_answer_phone" else unmarked).alias(k) for i, k in enumerate(names)]))

    return bound(F.split(context, "\n"), sections)


def chat_messages(system: str, context: Column, question: Column, closing: str = "Answer the question with the help of this context.") -> Column:
    """A system and a user message."""
    message = lambda role, x: F.struct(F.lit(role).alias("role"), x.alias("content"))
    return F.array(message("system", F.lit(system)), message("user", F.concat_ws("\n\n", context, question, F.lit(closing))))
