import hashlib
import random
import re
import uuid
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from oddspend.llm import prefix_trie, source_divergence as S, token_cache
from oddspend.session import shared_dir

PATH = public_tokenizers.path("byte_bpe_50k.json")
TERM = re.compile("[^\x00-\x40\x5b-\x60\x7b-\x7f]+")


# --- divergence of sources -------------------------------------------------------------------


def fold(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text)


def brute_audit(rows, min_docs=10, top=10):
    """rows: (text, lang, source)."""
    groups, in_docs = defaultdict(Counter), defaultdict(Counter)
    for text, lang, source in rows:
        terms = TERM.findall(fold(text or ""))
        groups[lang or "", source or ""].update(terms)
        in_docs[lang or ""].update(set(terms))
    kept = {lang: [t for t, n in c.items() if n >= min_docs] for lang, c in in_docs.items()}
    out = set()

    def shares(count, terms):
        total = sum(count[t] for t in terms)
        return {t: 1 + 10**9 * (count[t] + 2) // (total + 2 * len(terms)) for t in terms}

    f = lambda p, q: (p - q) ** 2 // (p + q)
    for lang, terms in {g[0]: kept.get(g[0], []) for g in groups}.items():
        of = {s: shares(c, terms) for (g, s), c in groups.items() if g == lang}
        q = shares(sum((c for (g, _), c in groups.items() if g == lang), Counter()), terms)
        for s, p in of.items():
            pairs = [(sum(f(p[t], o[t]) for t in terms), x) for x, o in of.items() if x != s]
            more = [(f(p[t], q[t]), t) for t in terms if groups[lang, s][t] and p[t] > q[t]]
            for part, found in (("pair", pairs), ("term", more)):
                found.sort(key=lambda x: (-x[0], x[1].encode()))
                out |= {(lang, s, part, item, v, k + 1) for k, (v, item) in enumerate(found) if part == "pair" or k < top}
    return out


def audit(spark, rows, **how):
    docs = spark.createDataFrame([(*r, "x", 1) for r in rows], "text string, lang string, source string, term string, n int")
    return {tuple(r) for r in S.audit(docs, **how).collect()}


def test_audit_equals_brute_force(spark):
    rng = random.Random(5)
    words = [*"abcdefgh", "été", "中文", "Zoë", "x'y", "don't", "a1b", "_", "É"]
    rows = [(" ".join(rng.choices(words, range(1, len(words) + 1), k=rng.randint(0, 30))), rng.choice(["en", "fr", None]), rng.choice("stuv")) for _ in range(120)]
    rows += [(None, "en", "none"), ("", "de", "s"), ("only once", "de", "t"), (None, None, None), ("A b\x00c", "en", "s"), ("A b\x00c", "en", "s")]
    assert audit(spark, rows) == brute_audit(rows)
    assert audit(spark, rows, min_docs=2, top=3) == brute_audit(rows, 2, 3)
    assert audit(spark, []) == set()


def test_many_terms_fill_several_blocks(spark):
    rng = random.Random(6)
    rows = [(" ".join(f"{chr(97 + k % 26)}{'xyz'[k % 3] * (k // 78)}q" for k in rng.sample(range(12_000), 5_000)), "en", s) for s in "abc" for _ in range(2)]
    assert audit(spark, rows, min_docs=1) == brute_audit(rows, 1)


def test_terms_of_texts_cut_in_pieces(monkeypatch):
    rng = random.Random(7)
    text = "".join(rng.choice("aBé中 .\n1") for _ in range(3000)) + "é" * 500
    want = [t.encode() for t in TERM.findall(fold(text))]
    for size in (1, 7, 64, 10_000):
        monkeypatch.setattr(S, "PIECE", size)
        assert [t for part in S.term_lists(text.encode()) for t in part] == want


def test_gallop_and_exact_shares():
    rng = np.random.default_rng(8)
    for n, m in ((0, 5), (5, 0), (1, 1), (50, 4000), (3000, 4000), (200, 201)):
        few, many = (np.sort(rng.choice(5000, size, replace=False)).astype("int64") for size in (n, m))
        place = {v: k for k, v in enumerate(many.tolist())}
        assert S.gallop(few, many).tolist() == [place.get(v, -1) for v in few.tolist()]
    counts = np.array([0, 1, 10**14, 8 * 10**15 - 3], dtype="int64")
    total, terms = 8 * 10**15, 10**9
    assert S._shares(counts, total, terms).tolist() == [1 + 10**9 * (c + 2) // (total + 2 * terms) for c in counts.tolist()]


# --- token counts ----------------------------------------------------------------------------


def cache_of(spark):
    return f"{shared_dir(spark)}/cache-{uuid.uuid4().hex}"


def test_counts_are_those_of_the_library_and_misses_are_encoded_once(spark, odd, documents, monkeypatch):
    library, cache = Tokenizer.from_file(PATH), cache_of(spark)
    docs = documents.select("doc_id", "text").unionByName(odd.select("doc_id", "text"))
    docs = docs.unionByName(spark.createDataFrame([(90, "<|endoftext|> a  b\n\n c<|endoftext|>"), (91, "<|endoftext|> a  b\n\n c<|endoftext|>")], "doc_id bigint, text string"))
    docs = docs.withColumn("digest", F.lit("x")).withColumn("n_tokens", F.lit(1))
    want = sorted((str(r["doc_id"]), len((r["text"] or "").encode()), n := len(library.encode(r["text"] or "", add_special_tokens=False).ids), n > 1024) for r in docs.collect())
    found = token_cache.count_tokens(docs, PATH, cache)
    assert found.columns == ["doc_id", "n_bytes", "n_tokens", "over_limit"]
    assert sorted((str(r[0]), *r[1:]) for r in found.collect()) == want
    kept = spark.read.parquet(cache)
    assert kept.count() == docs.select(F.coalesce("text", F.lit(""))).distinct().count()

    def refuse(path):  # all are stored now: nothing may be encoded
        def run(batches):
            for batch in batches:
                assert not batch.num_rows
                yield batch
        return run

    monkeypatch.setattr(token_cache, "_counted", refuse)
    assert sorted((str(r[0]), *r[1:]) for r in token_cache.count_tokens(docs, PATH, cache).collect()) == want
    assert spark.read.parquet(cache).count() == kept.count()
    assert token_cache.count_tokens(docs.limit(0), PATH, cache).count() == 0


@pytest.mark.parametrize("name", ["word_bpe_49k.json", "piece_bpe_32k.model"])
def test_other_tokenizers_have_counts_of_their_own(spark, name):
    path, cache = public_tokenizers.path(name), cache_of(spark)
    texts = ["", "Two  words", "Two words", "two\t\nwords", "<|STARTOFTEXT|> x", "<|startoftext|> x", "<s> été 中文 </s>", " lead and trail ", None]
    if name.endswith(".model"):
        model = sentencepiece.SentencePieceProcessor(model_file=path)
        want = [len(model.encode(t or "")) for t in texts]
    else:
        want = [len(Tokenizer.from_file(path).encode(t or "", add_special_tokens=False).ids) for t in texts]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    token_cache.count_tokens(docs, PATH, cache).collect()
    for _ in range(2):
        assert [r["n_tokens"] for r in token_cache.count_tokens(docs, path, cache).orderBy("doc_id").collect()] == want


# --- trie of conversations -------------------------------------------------------------------


def brute_trie(convs):
    """convs: conv_id -> list of (role, text)."""
    members, below, ends = defaultdict(set), defaultdict(set), defaultdict(list)
    for c, turns in convs.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].add(c)
            if d:
                below[tuple(turns[: d - 1])].add(tuple(turns[:d]))
        ends[tuple(turns)].append(c)
    sums = {}
    for node in sorted(members, key=len, reverse=True):
        own = (len(members[node]) - 1) * len(node[-1][1].encode()) if node else 0
        sums[node] = (sum(sums[x][0] for x in below[node]) or 1, own + sum(sums[x][1] for x in below[node]))
    return sorted(
        (min(m), len(node), min(members[node[:-1]]) if node else None, len(m), len(below[node]), *sums[node],
         hashlib.sha256(",".join(map(str, sorted(ends[node]))).encode()).hexdigest())
        for node, m in members.items()
    )


def ordered(found):
    return sorted((tuple(r) for r in found), key=lambda r: (r[0], r[1]))


def read_convs(rows):
    convs = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            convs[c].append((turn is not None, turn or 0, role or "", text or ""))
    return {c: [(r, t) for _, _, r, t in sorted(x)] for c, x in convs.items()}


SCHEMA = "conv_id bigint, turn bigint, role string, text string"


def random_convs(seed, n, most):
    rng, rows = random.Random(seed), []
    for c in rng.sample(range(-n, 3 * n), n):
        for k in range(rng.randint(1, most)):
            rows.append((c, rng.choice([k, k, None]) if rng.random() < 0.1 else k, rng.choice(["u", None]) if k % 2 else "a", "t" * rng.choice([1, 1, 1, 2, 3]) if k < most - 4 else "é"))
    return rows


@pytest.mark.parametrize("size", [3, 512])
def test_trie_equals_brute_force(spark, size):
    """Segments of two and three turns make many rounds; a conversation that many repeat makes
    splitters alike."""
    rows = random_convs(size, 150, 9)
    rows += [(1000 + c, k, "u", f"same {k}") for c in range(60) for k in range(7)] + [(2000, k, "u", f"long {k}") for k in range(40)]
    rows += [(c, k, "u", f"deep {k}") for c in (3000, 3001, 3002) for k in range(20 + c % 3)]
    rows += [(None, 0, "u", "nobody"), (4000, None, None, None), (4000, None, None, None), (4001, 3, "", "")]
    rows = [r for r in rows if r]
    random.Random(1).shuffle(rows)
    turns = spark.createDataFrame([(*r, 1, b"x") for r in rows], SCHEMA + ", d int, path binary").repartition(5)
    assert ordered(prefix_trie.trie(turns, size).collect()) == brute_trie(read_convs(rows))
    assert prefix_trie.trie(turns.limit(0), size).count() == 0


def test_places_of_a_conversation_that_fills_many_tasks(spark):
    rows = [(7, k, "u", str(k)) for k in range(20_000)] + [(c, 0, "u", "x") for c in range(7)]
    turns, convs = prefix_trie.number_turns(spark.createDataFrame(rows, SCHEMA).repartition(6))
    assert turns.filter("conv_id = 7").agg(F.count_distinct("d"), F.min("d"), F.max("d")).first() == (20_000, 1, 20_000)
    assert {r["conv_id"]: r["n"] for r in convs.collect()} == {7: 20_000} | dict.fromkeys(range(7), 1)
    found = prefix_trie.build(turns, convs)
    assert found.count() == 20_000 + 2 and found.filter("conv_id = 7 and depth > 0").agg(F.max("depth"), F.sum("n_children")).first() == (20_000, 19_999)


def test_shared_heads_equal_brute_force(spark):
    rows = random_convs(9, 80, 12)
    convs = read_convs(rows)
    rebuilt = {}
    for c, own in convs.items():
        h = zlib.crc32(str(c).encode()) % 9
        base = c - (c % 5 if c >= 0 else -(-c % 5))
        rebuilt[c] = convs.get(base, [])[:h] + own[h:]
    turns = prefix_trie.number_turns(spark.createDataFrame(rows, SCHEMA))
    assert any(not x for x in rebuilt.values())
    assert ordered(prefix_trie.build(*prefix_trie.share_heads(*turns), 4).collect()) == brute_trie(rebuilt)
