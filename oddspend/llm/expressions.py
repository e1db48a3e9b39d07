"""Column expressions shared by the native operators."""

from pyspark.sql import Column, functions as F

#: Fixed white space of the word definition: space and the controls from tab to carriage return.
BLANKS = " \t\n\x0b\x0c\r"


def let(value: Column, body) -> Column:
    """body(value), with value computed once however often body uses it, and only where
    the expression is reached."""
    return F.transform(F.array(value), body)[0]


def words(text: Column) -> Column:
    """The words `[^\\x20\\x09-\\x0D]+` of a text; no words for null."""
    inner = F.btrim(text, F.lit(BLANKS))
    return F.when(F.length(inner) > 0, F.split(inner, r"[\x20\x09-\x0D]+")).otherwise(F.array().cast("array<string>"))


def spans(text: Column, pattern: str, last: Column | None = None) -> Column:
    """(start, end) in code points of the leftmost non-overlapping matches of a pattern that
    never matches nothing: the pieces between the matches give the places."""
    lengths = F.arrays_zip(
        F.transform(F.split(text, pattern, -1), F.length).alias("gap"),
        F.transform(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), F.length).alias("size"),
    )
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,end:int>>").alias("found"))

    def step(state, x):
        first = state["at"] + x["gap"]
        end = first + x["size"]
        return F.when(x["size"].isNull(), state).otherwise(
            F.struct(end.alias("at"), F.concat(state["found"], F.array(F.struct(first.alias("start"), end.alias("end")))).alias("found"))
        )

    return F.aggregate(lengths, start, step, lambda s: s["found"])
