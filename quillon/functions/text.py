"""Text functions as Column expressions, with Python's notion of white space and truth."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Fixed value: what marks an empty section.
NONE_MARK = "（无）"
#: The answer that stands in for a failed generation.
PLACEHOLDER = "[no answer was generated]"
END_OF_REASONING = "</think>"
_SPACE = r"[\s\x1c-\x1f]"


def _column(x: Column | str) -> Column:
    return F.col(x) if isinstance(x, str) else x


def strip(x: Column | str) -> Column:
    """Without white space of any script at either end."""
    return F.regexp_replace(_column(x), rf"(?U)\A{_SPACE}+|{_SPACE}+\z", "")


def lstrip(x: Column | str) -> Column:
    return F.regexp_replace(_column(x), rf"(?U)\A{_SPACE}+", "")


def text_or_empty(x: Column | str) -> Column:
    return F.coalesce(_column(x), F.lit(""))


def filled(x: Column | str) -> Column:
    """Whether there is anything but white space."""
    return strip(text_or_empty(x)) != ""


def stripped_or_mark(x: Column | str) -> Column:
    s = strip(text_or_empty(x))
    return F.when(s == "", F.lit(NONE_MARK)).otherwise(s)


def joined(sep: str, *parts: Column) -> Column:
    """Parts that are not null, joined."""
    return F.array_join(F.array_compact(F.array(*parts)), sep)


def candidate_id(sample_id: Column, model_name: Column, index: Column | None = None) -> Column:
    """sample::model (or sample::model#i) with eight hex digits of its SHA-1 behind."""
    base = F.concat(sample_id, F.lit("::"), model_name, *([F.lit("#"), index.cast("string")] if index is not None else []))
    return F.concat(base, F.lit("::"), F.substring(F.sha1(base), 1, 8))


def strip_reasoning(response: Column, model_name: Column, models: list[str]) -> Column:
    """For these models only what follows the last end-of-reasoning mark."""
    after = lstrip(F.substring_index(response, END_OF_REASONING, -1))
    return F.when(model_name.isin(models) & F.contains(response, F.lit(END_OF_REASONING)), after).otherwise(response)


def is_placeholder(response: Column) -> Column:
    """Blank, or the default stand-in for a failed generation."""
    s = strip(text_or_empty(response))
    return (s == "") | (s == PLACEHOLDER)


def preview(x: Column, n: int = 200) -> Column:
    flat = F.replace(F.substring(x, 1, n), F.lit("\n"), F.lit(" "))
    return F.when(F.length(x) > n, F.concat(flat, F.lit("..."))).otherwise(flat)


def record_title(number: Column, fields: dict[str, Column], n: int = 60) -> Column:
    """'#i | field: text' with the first field that is not empty, cut at n characters; else '#i'."""
    base = F.concat(F.lit("#"), number.cast("string"))
    out = base
    for name, x in reversed(fields.items()):
        short = F.when(F.length(x) > n, F.concat(F.substring(x, 1, n), F.lit("..."))).otherwise(x)
        out = F.when(text_or_empty(x) != "", F.concat(base, F.lit(f" | {name}: "), short)).otherwise(out)
    return out


def split_reference(x: Column) -> Column:
    """Two (label, content) structs of 'label:content ||| label:content'; null without the separator."""
    sides = F.split(x, r"\|\|\|", 2)

    def side(k: int) -> Column:
        body = strip(sides[k])
        cut = F.instr(body, ":")
        label = strip(F.substring_index(body, ":", 1))
        return F.struct(
            F.when((cut > 0) & (label != ""), label).otherwise(F.lit(f"answer_{k + 1}")).alias("label"),
            F.when(cut > 0, lstrip(F.substr(body, cut + 1))).otherwise(body).alias("content"),
        )

    return F.when(F.size(sides) == 2, F.array(side(0), side(1)))


def has_markdown(answer: Column) -> Column:
    """Whether an answer has a heading, a list or a table; the marks are fixed values."""
    has = lambda x: F.contains(answer, F.lit(x))
    return has("#") | has("- ") | has("* ") | (has("|") & has("\n|-"))


def number(x: Column | str) -> Column:
    """A double, or null for what is no number (also NaN)."""
    v = _column(x).try_cast("double")
    return F.when(~F.isnan(v), v)


def bound(x: Column, then: Callable[[Column], Column]) -> Column:
    """then(x), with x worked out once, however often then uses it."""
    return F.transform(F.array(x), then)[0]
