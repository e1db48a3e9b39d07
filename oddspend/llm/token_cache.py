"""Token counts through a cache of digests.

A count is stored under two digests: SHA-256 of the content, and one of the tokenizer (its
file and the library's version), so another vocabulary never meets old counts. Documents are
reduced to digests first; digests that the cache lacks are made distinct, one document of each
is encoded, and its count is appended. Counts go back to the documents by digest.

Content is normalised before it is digested as far as this cannot change a count: null becomes
the empty text, and where the tokenizer's own normaliser makes every run of white space one
space, so does the digest.

Only small rows are shuffled but for the texts to encode, which meet the list of misses by
(digest, id): copies spread by id, and when few are missing Spark sends the list to the texts
instead. A digest that a third of all documents share is one row of the cache, and is joined as
a hot key. The cache is a folder of Parquet files; each call adds files, none are rewritten, and
a count that two callers append at a time is read once.

Each row gets its result, repeated or not; rows that share both id and text are encoded as often
as they come if they are missing. Null ids are ids like any other. Empty tables give no rows and
leave the cache as it is. Long texts are counted in pieces by the byte-level encoder, as a whole
by the others. Other columns are ignored, whatever their names.
"""

import functools
import hashlib
import json

import pyarrow as pa
import sentencepiece
import tokenizers
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from oddspend.functions.lookup import lookup_join
from oddspend.llm import tokens
from oddspend.session import materialize

STORED = "digest binary, n_tokens bigint"


def version(path: str) -> str:
    """Digest of what decides a count besides the content."""
    library = f"sentencepiece {sentencepiece.__version__}" if path.endswith(".model") else f"tokenizers {tokenizers.__version__}"
    with open(path, "rb") as file:
        return hashlib.sha256(library.encode() + b"\0" + file.read()).hexdigest()


def _parts(found) -> list[dict]:
    """A component of a tokenizer file as a list of its steps."""
    return [] if found is None else [y for x in found.get("normalizers") or found.get("pretokenizers") or [found] for y in ([x] if x is found else _parts(x))]


@functools.lru_cache(maxsize=4)
def _file(path: str) -> dict:
    with open(path, encoding="utf-8") as file:
        return json.load(file)


def normalised(text: Column, path: str) -> Column:
    """The content that a digest stands for; equal contents have equal counts."""
    text = F.coalesce(text, F.lit(""))
    folds = not path.endswith(".model") and any(x["type"] == "Replace" and x["pattern"].get("Regex") == r"\s+" and x["content"] == " " for x in _parts(_file(path).get("normalizer")))
    return F.regexp_replace(text, "[ \\t\\n\\r]+", " ") if folds else text


@functools.lru_cache(maxsize=4)
def counter(path: str):
    """texts -> counts, without begin, end or added special tokens, as the file's library counts them."""
    if path.endswith(".model"):
        model = sentencepiece.SentencePieceProcessor(model_file=path)
        return lambda texts: [len(x) for x in model.encode(texts, num_threads=1)]
    data = _file(path)
    cuts = _parts(data.get("pre_tokenizer"))
    if data.get("normalizer") is None and [(x["type"], x.get("add_prefix_space"), x.get("use_regex", True)) for x in cuts] == [("ByteLevel", False, True)]:
        count = tokens.ids(path).count
        return lambda texts: [count(x) for x in texts]
    library = tokenizers.Tokenizer.from_file(path)
    library.no_truncation()
    library.no_padding()
    return lambda texts: [len(x.ids) for x in library.encode_batch(texts, add_special_tokens=False)]


def stored(spark: SparkSession, cache: str, path: str) -> DataFrame:
    """The counts that the cache has for this tokenizer; a digest comes once."""
    folder = f"{cache}/tokenizer={version(path)}"
    name = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    if not name.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(name):
        return spark.createDataFrame([], STORED)
    return spark.read.schema(STORED).parquet(folder).groupBy("digest").agg(F.max("n_tokens").alias("n_tokens"))


def _counted(path: str):
    def run(batches):
        count = counter(path)
        for batch in batches:
            for k in range(0, batch.num_rows, 256):
                part = batch.slice(k, 256)
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(count(part.column(1).to_pylist()), pa.int64())], names=["digest", "n_tokens"])

    return run


def count_tokens(docs: DataFrame, path: str, cache: str, limit: int = 1024, key: str = "doc_id", text: str = "text") -> DataFrame:
    """key, n_bytes, n_tokens, over_limit of each row; the cache has all its counts afterwards."""
    spark = docs.sparkSession
    digest = F.unhex(F.sha2(normalised(F.col(text), path), 256)).alias("digest")
    rows = materialize(docs.select(F.col(key).alias("id"), digest, F.coalesce(F.octet_length(text), F.lit(0)).cast("bigint").alias("n_bytes")), "content_digests")
    known = rows.groupBy("digest").agg(F.min("id").alias("first"), F.count(F.lit(1)).alias("copies"))
    known = materialize(known.join(stored(spark, cache, path), "digest", "left"), "known_digests")
    missing = known.filter("n_tokens IS NULL").select("digest", "first")
    texts = docs.select(F.col(key).alias("id"), digest, F.coalesce(F.col(text), F.lit("")).alias("text"))
    texts = texts.join(missing, (texts["digest"] == missing["digest"]) & texts["id"].eqNullSafe(missing["first"]), "left_semi")
    new = texts.select("digest", "text").mapInArrow(_counted(path), STORED).groupBy("digest").agg(F.max("n_tokens").alias("n_tokens"))
    new = materialize(new, "new_counts")
    if not new.isEmpty():
        new.write.mode("append").parquet(f"{cache}/tokenizer={version(path)}")
    counts = known.filter("n_tokens IS NOT NULL").select("digest", "n_tokens", "copies").unionByName(
        known.select("digest", "copies").join(new, "digest").select("digest", "n_tokens", "copies"))
    found = lookup_join(rows, counts, "digest", known.count(), "copies", "id")
    return found.select(F.col("id").alias(key), "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))
