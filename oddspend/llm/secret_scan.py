"""Secrets in texts, with column expressions only.

Known forms come first: assignments to a secret-like name, access keys, long hex strings.
The method adds candidate strings that look drawn at random: a window slides over the
candidate, the counts of its characters are kept up to date by the one that enters and the
one that leaves, and the candidate is reported if the Shannon entropy of some window reaches
the threshold of its character class. Candidates on the allow list are suppressed, as are
those that a known form covers already.

Spans are code points, end exclusive. Null texts are empty; texts without a secret give no
spans. Rows are independent: repeated rows and ties give equal results, other columns are
ignored, an empty table gives an empty result.
"""

import math

from pyspark.sql import Column, DataFrame, functions as F

from oddspend.llm.expressions import let, spans

#: Fixed patterns and least lengths of the known forms.
ASSIGN = r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ASSIGN_LEAST = 6
ACCESS, ACCESS_LEAST = "AKIA[A-Z0-9]+", 20
HEX, HEX_LEAST = "[0-9a-f]+", 24
KINDS = ("assign", "access", "hex", "entropy")

WINDOW = 20
CANDIDATE = r"[A-Za-z0-9+/_=-]{20,}"
ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-"
#: Character classes, narrowest first, with the entropy in bits that a window must reach.
CLASSES = ((r"^[0-9]+$", math.inf), (r"^[0-9a-fA-F]+$", 2.9), (r"^(?:[0-9a-z]+|[0-9A-Z]+)$", 3.4), (r"^[0-9A-Za-z]+$", 3.5), (r"", 3.5))
#: Candidates that are no secrets: placeholders, identifiers of known form, runs of words, paths.
ALLOWED = (
    r"(?i)example|placeholder|changeme|dummy|sample|xxxx|test_?key",
    r"^[0-9a-fA-F]{8}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{12}$",
    r"^[^0-9]*$",
    r"^(?:[A-Za-z]+|[0-9]{1,8})(?:[-_/=+]+(?:[A-Za-z]+|[0-9]{1,8}))*[-_/=+]*$",
    r"(.)\1{5}",
)


def window_entropy(text: Column, width: int = WINDOW) -> Column:
    """The largest Shannon entropy, in bits, of a window of `width` characters of ALPHABET.

    The state holds a count for each character and the sum of count x log2(count); a step
    changes two counts and the sum by their differences."""
    logs = F.array(*[F.lit(0.0 if c < 2 else c * math.log2(c)) for c in range(width + 2)])
    zero = F.struct(F.array_repeat(F.lit(0), len(ALPHABET) + 1).alias("counts"), F.lit(0.0).alias("sum"), F.lit(0.0).alias("best"))

    def scan(codes: Column) -> Column:
        def step(state, i):
            entering, leaving = F.get(codes, i), F.get(codes, i - width)
            counts, n = state["counts"], F.get(state["counts"], F.get(codes, i))
            grown = state["sum"] + F.get(logs, n + 1) - F.get(logs, n)
            # the count of the leaving character as it is after the other has entered
            m = F.get(counts, leaving) + F.when(entering == leaving, 1).otherwise(0)
            total = F.when(i < width, grown).otherwise(grown + F.get(logs, m - 1) - F.get(logs, m))
            counts = F.transform(counts, lambda c, k: c + (k == entering).cast("int") - F.coalesce((k == leaving).cast("int"), F.lit(0)))
            entropy = F.when(i < width - 1, F.lit(0.0)).otherwise(F.lit(math.log2(width)) - total / width)
            return F.struct(counts.alias("counts"), total.alias("sum"), F.greatest(state["best"], entropy).alias("best"))

        return F.aggregate(F.sequence(F.lit(0), F.size(codes) - 1), zero, step, lambda s: s["best"])

    codes = F.transform(F.split(text, ""), lambda c: F.instr(F.lit(ALPHABET), c))
    return let(codes, scan)


def is_secret(text: Column) -> Column:
    """Does a candidate reach the entropy of its class, and is it not on the allow list?"""
    least = F.when(F.lit(False), 0.0)
    for pattern, bits in CLASSES[:-1]:
        least = least.when(text.rlike(pattern), bits)
    least = least.otherwise(CLASSES[-1][1])
    allowed = F.lit(False)
    for pattern in ALLOWED:
        allowed = allowed | text.rlike(pattern)
    return F.when(allowed, False).otherwise(let(least, lambda bits: F.when(bits > 9, False).otherwise(window_entropy(text) >= bits)))


def _known(text: Column, kind: str) -> Column:
    """Spans of a known form, cheaply empty where the form cannot occur."""
    none = F.array().cast("array<struct<start:int,end:int>>")
    if kind == "access":
        long = lambda s: s["end"] - s["start"] >= ACCESS_LEAST
        return F.when(F.contains(text, F.lit("AKIA")), F.filter(spans(text, ACCESS), long)).otherwise(none)
    if kind == "hex":  # runs are maximal, so the short ones can be left to the pattern
        return F.when(text.rlike(f"[0-9a-f]{{{HEX_LEAST}}}"), spans(text, f"[0-9a-f]{{{HEX_LEAST},}}")).otherwise(none)
    values = F.transform(F.regexp_extract_all(text, F.lit(ASSIGN), F.lit(1)), F.length)
    both = F.arrays_zip(spans(text, ASSIGN).alias("span"), values.alias("size"))
    found = F.transform(F.filter(both, lambda x: x["size"] >= ASSIGN_LEAST), lambda x: x["span"])
    return F.when(text.rlike(ASSIGN), found).otherwise(none)


def scan(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """key, assign, access, hex, entropy: arrays of (start, end)."""
    rows = docs.select(F.col(key), F.coalesce(F.col(text), F.lit("")).alias("text"))
    rows = rows.select(key, "text", *[_known(F.col("text"), kind).alias(kind) for kind in KINDS[:3]])
    base = F.concat(*KINDS[:3])
    candidates = F.arrays_zip(spans(F.col("text"), CANDIDATE).alias("span"), F.regexp_extract_all("text", F.lit(CANDIDATE), F.lit(0)).alias("word"))
    apart = lambda x: ~F.exists(base, lambda b: (b["start"] < x["span"]["end"]) & (x["span"]["start"] < b["end"]))
    found = F.transform(F.filter(candidates, lambda x: F.when(apart(x), is_secret(x["word"])).otherwise(False)), lambda x: x["span"])
    none = F.array().cast("array<struct<start:int,end:int>>")
    return rows.select(key, *KINDS[:3], F.when(F.col("text").rlike(CANDIDATE), found).otherwise(none).alias("entropy"))


def joined(kinds) -> Column:
    """kind:start:end, by start and then kind, comma-joined."""
    def numbered(kind):
        return F.transform(kind, lambda s: F.struct(s["start"], F.lit(KINDS.index(kind)).alias("kind"), s["end"]))

    every = F.concat(*map(numbered, kinds))
    names = F.array(*map(F.lit, KINDS))
    return F.concat_ws(",", F.transform(F.sort_array(every), lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"], s["end"])))


def digests(found: DataFrame, key: str = "doc_id") -> DataFrame:
    counts = [F.size(kind).cast("bigint").alias(f"n_{kind}") for kind in KINDS[:3]]
    return found.select(key, *counts, F.sha2(joined(KINDS[:3]), 256).alias("base_sha256"), joined(KINDS).alias("spans"))
