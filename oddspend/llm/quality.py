"""Quality rules as a short-circuit cascade, with column expressions only.

Each rule rejects a document by its text. On a sample the time and the share rejected of
each rule are measured, and rules are tried in order of rejection per cost; the first that
rejects ends the cascade (a chain of CASE branches, of which Spark evaluates no more than
it needs). A document is kept if no rule rejects it, so the order changes the cost only.

Null texts have no words and are rejected for it. Rows are independent: repeated rows and
ties get equal verdicts, other columns are untouched, an empty table gives an empty result
(rules then stay in their given order).
"""

import time

from pyspark.sql import Column, DataFrame, functions as F

from oddspend.llm.expressions import let, words
from oddspend.session import materialize

#: Fixed numbers of the base rules.
LEAST_WORDS, REPEATED_SHARE, WINDOW = 20, 30, 8
SYMBOLS = "#*$%&|<>"
SAMPLE = 1000  # rows (about) on which costs are measured


def lines_of(text: Column) -> Column:
    """The \\n-split lines that hold a word."""
    return F.filter(F.split(text, "\n"), lambda x: F.length(F.btrim(x, F.lit(" \t\n\x0b\x0c\r"))) > 0)


def repeat_words(words: Column, width: int = WINDOW) -> Column:
    """Words inside windows of `width` words that the text holds twice or more.

    Windows are compared by 64-bit hashes. Texts without a repeated window stop at a count of
    distinct hashes; others sort (hash, place) and add up what the repeated windows cover."""
    n = F.size(words)
    hashes = F.transform(F.sequence(F.lit(1), n - width + 1), lambda i: F.xxhash64(F.slice(words, i, width)))

    def covered(places: Column) -> Column:
        start = F.struct(F.lit(0).alias("end"), F.lit(0).alias("n"))
        step = lambda s, p: F.struct((p + width).alias("end"), (s["n"] + p + width - F.greatest(s["end"], p)).alias("n"))
        return F.aggregate(places, start, step, lambda s: s["n"])

    def repeated(pairs: Column) -> Column:
        # a comparison with what is not there is null; the other neighbour may still be equal
        either = lambda x, i: F.coalesce(F.get(pairs, i - 1)["h"] == x["h"], F.lit(False)) | F.coalesce(F.get(pairs, i + 1)["h"] == x["h"], F.lit(False))
        return covered(F.sort_array(F.transform(F.filter(pairs, either), lambda x: x["p"])))

    def find(h: Column) -> Column:
        pairs = F.sort_array(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("p"))))
        return F.when(F.size(F.array_distinct(h)) < F.size(h), let(pairs, repeated)).otherwise(0)

    return F.when(n > width, let(hashes, find)).otherwise(0)


def measures(text: Column, words: Column) -> dict[str, Column]:
    """The base measures of a text (null as empty), as long."""
    lines = let(lines_of(text), lambda x: F.size(x) - F.size(F.array_distinct(x)))
    found = {
        "n_words": F.size(words),
        "word_chars": F.length(F.regexp_replace(text, r"[\x20\x09-\x0D]+", "")),
        "n_symbols": F.length(F.regexp_replace(text, r"[^#*$%&|<>]+", "")),
        "n_dup_lines": lines,
        "n_repeat_words": repeat_words(words),
    }
    return {k: v.cast("bigint") for k, v in found.items()}


def rules(text: Column, words: Column) -> dict[str, Column]:
    """Rejections by name; each is an expression of its own, evaluated where the cascade reaches it."""
    m, n = measures(text, words), F.size(words)
    letters = F.length(F.regexp_replace(text, r"\P{L}+", ""))
    return {
        "few_words": n < LEAST_WORDS,
        "many_symbols": 10 * m["n_symbols"] > n,
        "odd_word_length": (m["word_chars"] < 2 * n) | (m["word_chars"] > 15 * n),
        "few_letters": 2 * letters < m["word_chars"],
        "shouting": let(letters, lambda x: (x >= 20) & (2 * F.length(F.regexp_replace(text, r"\P{Lu}+", "")) > x)),
        "repeated_lines": let(lines_of(text), lambda x: (F.size(x) >= 4) & (10 * (F.size(x) - F.size(F.array_distinct(x))) > 3 * F.size(x))),
        "stuttering": 5 * F.size(F.filter(words, lambda x, i: F.coalesce(F.get(words, i - 1) == x, F.lit(False)))) > n,
        "repeated_words": 100 * m["n_repeat_words"] > REPEATED_SHARE * n,
    }


def order_rules(docs: DataFrame, text: str = "text", sample: int = SAMPLE) -> list[dict]:
    """Rules by rejection per cost on a sample of about `sample` rows: name, rejected, seconds."""
    n = docs.count()
    names = list(rules(F.lit(""), words(F.lit(""))))
    if not n:
        return [{"name": x, "rejected": 0.0, "seconds": 0.0} for x in names]
    rows = docs.select(F.coalesce(F.col(text), F.lit("")).alias("t"))
    rows = materialize(rows.sample(min(1.0, sample / n), seed=5), "rule_sample", parallel=True).withColumn("w", words(F.col("t")))
    found = []
    for name, rule in {"": F.size("w") < 0, **rules(F.col("t"), F.col("w"))}.items():
        began = time.perf_counter()
        row = rows.agg(F.avg(rule.cast("double")).alias("x"), F.count(F.lit(1)).alias("n")).first()
        found.append({"name": name, "rejected": row["x"] or 0.0, "seconds": time.perf_counter() - began})
    base = min(x["seconds"] for x in found)
    return sorted(found[1:], key=lambda x: -x["rejected"] / max(x["seconds"] - base, 1e-3))


def cascade(text: Column, words: Column, order: list[dict]) -> Column:
    """Name of the first rule that rejects, null if none does."""
    every = rules(text, words)
    first, *rest = [x["name"] for x in order]
    out = F.when(every[first], first)
    for name in rest:
        out = out.when(every[name], name)
    return out


def judge(docs: DataFrame, text: str = "text", sample: int = SAMPLE) -> DataFrame:
    """docs with rejected_by: the rule that ended the cascade, null for documents to keep."""
    order = order_rules(docs, text, sample)
    rows = docs.withColumn("rejected_by", cascade(F.coalesce(F.col(text), F.lit("")), words(F.coalesce(F.col(text), F.lit(""))), order))
    return rows


def keep(docs: DataFrame, text: str = "text", sample: int = SAMPLE) -> DataFrame:
    """The documents that no rule rejects, with the columns of docs."""
    order = order_rules(docs, text, sample)
    t = F.coalesce(F.col(text), F.lit(""))
    return docs.filter(let(words(t), lambda w: cascade(t, w, order).isNull()))


def report(docs: DataFrame, key: str = "doc_id", text: str = "text", sample: int = SAMPLE) -> DataFrame:
    """key, base measures, base_failed and the cascade's verdict for every document."""
    order = order_rules(docs, text, sample)
    rows = docs.select(F.col(key), F.coalesce(F.col(text), F.lit("")).alias("t")).withColumn("w", words(F.col("t")))
    # base measures are wanted for all documents; the rules made of them are read from their columns
    rows = rows.select(key, "t", "w", *[v.alias(k) for k, v in measures(F.col("t"), F.col("w")).items()])
    rows = rows.withColumn("base_failed", (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > REPEATED_SHARE * F.col("n_words")))
    others = [x for x in order if x["name"] not in ("few_words", "repeated_words")]
    kept = F.when(F.col("base_failed"), False).otherwise(cascade(F.col("t"), F.col("w"), others).isNull())
    return rows.select(key, "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", kept.alias("kept"))
