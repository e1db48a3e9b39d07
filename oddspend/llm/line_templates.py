"""Line deduplication by a log-template tree, with column expressions only.

A line goes down a tree of fixed depth: its token count, then its leading tokens, fields that
hold a digit as `<*>`. Below, its templates generalise what varies between lines of one form.
Fields with a digit are variable everywhere. Other fields may be names or words, often of several
tokens: each of RUNS templates leaves one run of neighbouring places open and fixes all others.
The runs are about a quarter of the line long and spread evenly from its first token to its last,
overlapping by a token, so any two neighbouring places are open in one template; the first run takes
the wildcard branch at the leading tokens. A template fixes at least FIXED tokens, so lines of so many or fewer have the one
template without an open place. Two lines that differ within one run share a template; two that
only sound alike differ in more than one. All lengths follow this one rule, from one token on.

A template is recurring if lines of at least `min_docs` documents have it, two of them with
different ids. All lines with a recurring template are dropped (`keep_first=False`), or all
but those in the document with the smallest id that has it (`keep_first=True`, which leaves
one copy of what is repeated). A line is dropped if one of its templates says so. Only empty and
blank lines have no template. Rows count as documents for `min_docs`, repeated ids included.

Templates are counted by hash with partial sums; each document sends a template once. The
join back sends a row per line and template, no text, and Spark splits its partitions where a
template is hot. The text is shuffled once, to meet the numbers of its dropped lines.

Null texts stay null and hold no lines; empty lines stay. Rows with one id and one text are
one document; a null id is an id like any other. Documents that lose all lines keep their
row with an empty text. Extra columns are kept, whatever their names; an empty table gives
an empty result.
"""

from pyspark.sql import Column, DataFrame, functions as F

from oddspend.llm.expressions import BLANKS, let
from oddspend.session import materialize

RUNS, FIXED = 4, 3
NO_ID = -(1 << 63)


def masked(text: Column) -> Column:
    """The text with `<*>` for every field that holds a digit. A field is looked for at the blank
    before it (`\\s` is BLANKS), not at each of its characters, and in the whole text at once."""
    return F.regexp_replace(text, r"(^|\s)[^\s0-9]*+[0-9]\S*+", "$1<*>")


def templates(line: Column) -> Column:
    """Hashes of the templates of a line of a masked text; an empty array for lines that have none."""

    def of(t: Column) -> Column:
        n = F.size(t)
        width = F.least(F.call_function("div", n + 2 * RUNS - 2, F.lit(RUNS)), n - FIXED).cast("int")

        def opened(run: int) -> Column:
            first = F.call_function("div", run * (n - width), F.lit(RUNS - 1)).cast("int")
            return F.xxhash64(n, first, F.slice(t, F.lit(1), first), F.slice(t, first + width + 1, n))

        whole = F.when(F.element_at(t, 1) != "", F.array(F.xxhash64(n, t))).otherwise(F.array().cast("array<bigint>"))  # an empty line splits into one empty token
        return F.when(n > FIXED, F.array(*[opened(k) for k in range(RUNS)])).otherwise(whole)

    return let(F.split(F.btrim(line, F.lit(BLANKS)), r"[\x20\x09-\x0D]+"), of)


def drop_recurring(docs: DataFrame, min_docs: int = 2, keep_first: bool = False, key: str = "doc_id", text: str = "text") -> DataFrame:
    """docs without recurring lines, plus n_lines and n_dropped (named so unless docs has them)."""
    names = docs.columns
    own = lambda base: base if base not in names else own(base + "_")
    ident, body, gone, number, found = own("_id"), own("_hash"), own("_gone"), own("n_lines"), own("n_dropped")
    docs = docs.withColumn(ident, F.coalesce(F.col(key).cast("bigint"), F.lit(NO_ID))).withColumn(body, F.xxhash64(text))
    lines = docs.filter(F.col(text).isNotNull()).select(
        F.col(ident).alias("id"), F.col(body).alias("body"), F.transform(F.split(masked(F.col(text)), "\n"), templates).alias("lines")
    )
    lines = materialize(lines, "line_templates")  # hashes only; counted first, joined back next
    counts = lines.select("id", F.explode(F.array_distinct(F.flatten("lines"))).alias("template"))
    counts = counts.groupBy("template").agg(F.count(F.lit(1)).alias("n"), F.min("id").alias("first"), F.max("id").alias("last"))
    recurring = counts.filter((F.col("n") >= min_docs) & (F.col("first") < F.col("last"))).select("template", "first")
    places = lines.select("id", "body", F.posexplode("lines").alias("place", "templates")).select("id", "body", "place", F.explode("templates").alias("template"))
    hits = places.join(recurring, "template")
    if keep_first:
        hits = hits.filter(F.col("id") > F.col("first"))
    dropped = hits.groupBy("id", "body").agg(F.collect_set("place").alias("places"))
    dropped = dropped.select(F.col("id").alias(own("_id2")), F.col("body").alias(own("_hash2")), F.col("places").alias(gone))
    rows = docs.join(dropped, (F.col(ident) == F.col(own("_id2"))) & (F.col(body) == F.col(own("_hash2"))), "left")
    # the places left, found by hash: time in proportion to the lines, however many are dropped
    kept = let(F.split(text, "\n"), lambda x: F.transform(F.array_except(F.sequence(F.lit(0), F.size(x) - 1), F.col(gone)), lambda i: F.get(x, i)))
    cleaned = F.when(F.col(gone).isNull(), F.col(text)).otherwise(F.array_join(kept, "\n"))
    return rows.select(
        *[cleaned.alias(c) if c == text else F.col(f"`{c}`") for c in names],
        F.coalesce(F.size(F.split(text, "\n")), F.lit(0)).cast("bigint").alias(number),
        F.coalesce(F.size(gone), F.lit(0)).cast("bigint").alias(found),
    )
