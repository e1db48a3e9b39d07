import re

import corpus_pipeline as P
import public_tokenizers
from tokenizers import Tokenizer

import __spark_entry__
from oddspend.session import materialize
from llm.test_llm_rules import base_measures, brute_lines
from llm.test_llm_search_join import brute_links

FOLDER = "/root/testdata/sf0.001"


def test_stages_against_brute_force(spark, documents):
    """Every stage is compared with plain Python over its own input."""
    kept = materialize(P.quality_rules(spark, documents, FOLDER), "t")
    ids = {r["doc_id"] for r in kept.collect()}
    for r in documents.collect():
        m = base_measures(r["text"])
        if m[0] < 20 or 100 * m[4] > 30 * m[0] or 10 * m[2] > m[0]:
            assert r["doc_id"] not in ids
    lines = materialize(P.line_dedup(spark, kept, FOLDER), "t")
    want = {i: t for i, t, n in brute_lines([(r["doc_id"], r["text"]) for r in kept.collect()], 2, True) if not n or re.search(r"[^\x20\x09-\x0d]", t)}
    assert {r["doc_id"]: r["text"] for r in lines.collect()} == want
    near = materialize(P.near_copies(spark, lines, FOLDER), "t")
    rows = [(r["doc_id"], r["text"]) for r in lines.collect()]
    groups = brute_links(rows)[1]
    assert sorted(r["doc_id"] for r in near.collect()) == sorted(min(rows[k][0] for k in g) for g in groups.values())
    private = materialize(P.personal_data(spark, near, FOLDER), "t")
    assert private.count() == near.count() and not private.filter("text rlike '@mail[0-9]'").count()
    for stage in (kept, lines, near, private):
        assert stage.columns == documents.columns and not stage.filter("n_chars != length(text)").count()
    pieces = P.packed(spark, private, FOLDER).collect()
    encode = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json")).encode
    tokens = {r["doc_id"]: len(encode(r["text"], add_special_tokens=False).ids) + 1 for r in private.collect()}
    total = dict.fromkeys(tokens, 0)
    for r in pieces:
        total[r["doc_id"]] += r["length"]
    assert total == tokens


def test_near_copies_go_and_clean_documents_stay(spark, documents):
    text = " ".join(f"word{k}" for k in range(200))
    clean = " ".join(f"term{k}" for k in range(200))
    docs = spark.createDataFrame([(1, text, "en", "s", 1), (2, text, "en", "s", 1), (3, text.replace("word7 ", "other "), "en", "s", 1), (4, clean, "en", "s", 1)], documents.schema)
    assert sorted(r["doc_id"] for r in P.near_copies(spark, docs, FOLDER).collect()) == [1, 4]


def test_run_of_the_registered_query(spark):
    assert __spark_entry__.queries()["pipeline"](spark, FOLDER).count() > 0
    assert [n for n, _ in P.STAGES] == ["quality_rules", "line_dedup", "near_copies", "personal_data", "packed"]


def test_every_operator_is_registered():
    names = [n for n in __spark_entry__.queries() if re.match(r"op\d+_", n)]
    assert sorted(int(n[2:].split("_")[0]) for n in names) == list(range(1, 14))
