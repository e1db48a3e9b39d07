import hashlib
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from oddspend.llm import bpe, packing, tokens

PATH = public_tokenizers.path("byte_bpe_50k.json")
LETTERS = "abe  \n\t'sdt1²½Ⅷ中文é́\x1c\x1f\x85\xa0　🙂-_=.,!aaaaeeerrr"


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def ids(m, text):
    return np.frombuffer(b"".join(bpe.encode_chunks(m, text)), "<u4").tolist()


def odd_texts():
    rng = random.Random(1)
    for _ in range(1500):
        text = "".join(rng.choice(LETTERS) for _ in range(rng.randint(0, 60)))
        yield text.replace("b", "<|endoftext|>") if rng.random() < 0.2 else text
    yield from ("", "a" * 30_000, "ab" * 20_000 + " " + "1" * 5000, " " * 70_000 + "x", "-" * 9000 + "=" * 999)
    yield "".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(50_000))


def test_ids_are_those_of_the_library_and_decode_to_the_text(library):
    m = bpe.merges(PATH)
    for text in odd_texts():
        want = library.encode(text, add_special_tokens=False).ids
        assert ids(m, text) == want
        assert np.frombuffer(tokens.ids(PATH).encode(text), "<u4").tolist() == want
        assert bpe.TextMachine(m).feed(np.array(want, "<u4").tobytes(), True) == library.decode(want, skip_special_tokens=False)


def test_streaming_in_small_parts_gives_the_same_tokens_with_bounded_state(library):
    m, rng = bpe.merges(PATH), random.Random(2)
    for text in ("the" * 3000, "ab" * 3000, "".join(rng.choice("etaoin") for _ in range(6000)), "é中" * 900):
        machine, out, data = bpe.Transducer(m), [], text.encode()
        for k in range(0, len(data), 7):
            out += machine.feed(data[k : k + 7])
            assert len(machine.buffer) <= 2 * (m.lookahead + m.longest)
        assert out + machine.flush() == library.encode(text, add_special_tokens=False).ids
        assert machine.delay <= m.lookahead + m.longest


def test_the_transducer_runs_for_every_word_not_met_before(monkeypatch):
    m, fed = bpe.Merges(PATH), []
    real = bpe.Transducer.feed
    monkeypatch.setattr(bpe.Transducer, "feed", lambda self, data: fed.append(data) or real(self, data))
    ids(m, "one two one three two" + " tail-1")
    assert [x for x in fed if x] == [b"one", b" two", b" one", b" three", b" tail", b"-", b"1"]


@pytest.mark.parametrize("unit", ["中文é", "ab", "\n\nx", "-="])
def test_a_text_without_single_spaces_streams_in_bounded_memory(library, monkeypatch, unit):
    m, sizes = bpe.merges(PATH), []
    real = bpe.Transducer._step
    monkeypatch.setattr(bpe.Transducer, "_step", lambda self, data: real(self, data) or sizes.append(len(self.buffer)))
    text = unit * (300_000 // len(unit))
    chunks = list(bpe.encode_chunks(m, text))
    assert max(map(len, chunks)) <= 8 * bpe.CHUNK and max(sizes) <= 2 * (m.lookahead + m.longest)
    assert np.frombuffer(b"".join(chunks), "<u4").tolist() == library.encode(text, add_special_tokens=False).ids


def test_text_machine_holds_back_unfinished_characters():
    m = bpe.merges(PATH)
    every = ids(m, "é🙂中")
    machine = bpe.TextMachine(m)
    parts = [machine.feed(np.array([i], "<u4").tobytes()) for i in every] + [machine.feed(b"", True)]
    assert "".join(parts) == "é🙂中" and "�" not in "".join(parts)


def test_digests_of_odd_rows(odd, library):
    rows = bpe.digests(odd, PATH).collect()
    assert len(rows) == odd.count()
    for r, t in zip(rows, [x["text"] or "" for x in odd.collect()]):
        want = library.encode(t, add_special_tokens=False).ids
        assert r["n_tokens"] == len(want)
        assert r["ids_sha256"] == hashlib.sha256(np.array(want, "<u4").tobytes()).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256(t.encode()).hexdigest()
    assert bpe.digests(odd.limit(0), PATH).count() == 0


def test_encode_and_decode_columns(spark, odd):
    both = bpe.decode(bpe.encode(odd.select("doc_id", "text"), PATH), PATH, text="back").collect()
    assert all((r["text"] or "") == r["back"] for r in both)


def best_fit(lengths, size):
    room = []
    for n in sorted(lengths, reverse=True):
        fits = [k for k, r in enumerate(room) if r >= n]
        if fits:
            room[min(fits, key=lambda k: room[k])] -= n
        else:
            room.append(size - n)
    return len(room)


def test_plan_is_best_fit_decreasing_over_counts():
    rng = random.Random(3)
    for _ in range(60):
        size = rng.choice([5, 16, 50, 2048])
        counts = {n: rng.randint(1, 40) for n in rng.sample(range(1, size + 1), rng.randint(1, min(size, 30)))}
        slots = packing.plan(counts, size)
        used, ranks = {}, {}
        for n, rank, many, first, offset in slots:
            ranks.setdefault(n, []).extend(range(rank, rank + many))
            for q in range(first, first + many):
                used.setdefault(q, []).append((offset, n))
        assert all(sorted(ranks[n]) == list(range(c)) for n, c in counts.items())
        for content in used.values():
            end = 0
            for offset, n in sorted(content):
                assert offset == end
                end += n
            assert end <= size
        assert len(used) == best_fit([n for n, c in counts.items() for _ in range(c)], size)
    assert len(packing.plan({n: 10**9 + n for n in range(1, 2049)}, 2048)) < 50_000


@pytest.mark.parametrize("size", [7, 2048])
def test_packed_pieces_hold_every_token_once(spark, odd, documents, library, size):
    docs = odd.select("doc_id", "text").unionByName(documents.select((documents.doc_id + 100).alias("doc_id"), "text").limit(20))
    rows = packing.pack(docs, PATH, size).collect()
    texts = sorted(((r["doc_id"] or -1), library.encode(r["text"] or "", add_special_tokens=False).ids + [0]) for r in docs.collect())
    want = []
    for doc, every in texts:
        for piece, (start, n) in enumerate(packing.cut(len(every), size)):
            assert n == size or piece == 0
            want.append((doc, piece, start, n, zlib.crc32(np.array(every[start : start + n], "<u4").tobytes())))
    assert sorted((r["doc_id"] or -1, r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in rows) == sorted(want)
    by = {}
    for r in rows:
        by.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for content in by.values():
        end = 0
        for offset, n in sorted(content):
            assert offset == end
            end += n
        assert end <= size
    assert len(by) == best_fit([w[3] for w in want], size)
    assert packing.pack(odd.limit(0), PATH).count() == 0
