"""Byte-pair encoding as a streaming transducer, and decoding as a byte-to-text machine.

A byte-pair encoding is one state per byte: the last token of the encoding of the prefix
that ends there. Token t ends at byte i exactly if t is what the merges make of its own
bytes and the boundary to the state |t| bytes back survives all merges. Whether a boundary
survives depends on the two tokens beside it only: no pair of parts that touch it may have
a merge that comes due while both parts still stand alone.

Tokens are emitted once they are stable, that is once every state that a later token could
start from descends from them. The merge list itself bounds how far behind the input they
can stay (`lookahead`): what comes later reaches back over a chain of merges of rising rank
that contest one another's parts, and the longest such chain is computed from the list. The
buffer holds that many bytes, however long the text.

Null texts encode as the empty text; empty texts give no ids. Rows are independent, so
repeated rows, ties and extra columns change nothing.
"""

import array
import codecs
import functools
import hashlib
import json
import sys

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, functions as F

#: Fixed values of byte-level vocabularies: how a text is cut before merging; white space as Unicode has it.
SPACE = r"\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
CUT = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^" + SPACE + r"\p{L}\p{N}]+|[" + SPACE + r"]+(?![^" + SPACE + r"])|[" + SPACE + r"]+")
SPACES = regex.compile("[" + SPACE + "]{2}")
ONE_SPACE = regex.compile("[" + SPACE + "]")

CHUNK = 1 << 16  # characters cut at a time
WORDS = 400_000  # words whose ids a process remembers in each of two generations; forgetting them costs time only
INFINITE = 1 << 60
ONE = (1,)


def printable_bytes() -> dict[str, int]:
    """The character that stands for each byte in a byte-level vocabulary file: itself
    where it is printable, else the next free one from U+0100 on."""
    plain = [b for b in range(256) if 0x21 <= b <= 0x7E or 0xA1 <= b <= 0xAC or 0xAE <= b <= 0xFF]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(rest)}


class Merges:
    """A merge list: tokens as bytes, the parts of each, and which boundaries survive."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            data = json.load(file)
        byte = printable_bytes()
        vocab = data["model"]["vocab"]
        self.special = {x["content"]: x["id"] for x in data.get("added_tokens", [])}
        self.bytes_of = [b""] * (max([*vocab.values(), *self.special.values()]) + 1)
        for text, i in vocab.items():
            if text not in self.special:
                self.bytes_of[i] = bytes(byte[c] for c in text)
        for text, i in self.special.items():
            self.bytes_of[i] = text.encode()
        self.rank, self.parts = {}, {}
        created = {}
        for k, pair in enumerate(data["model"]["merges"]):
            left, right = pair if isinstance(pair, list) else pair.split(" ")
            a, b, whole = vocab[left], vocab[right], vocab[left + right]
            if whole in self.parts or max(created.get(a, -1), created.get(b, -1)) >= k:
                raise ValueError(f"merge {k} makes a token twice or before its parts")
            self.rank[a, b], self.parts[whole], created[whole] = k, (a, b), k
        # edges: the parts of a token that touch its end (its start), each with the rank at which it is merged away
        self.ends, self.starts, self.ids = {}, {}, {}
        for i, text in enumerate(self.bytes_of):
            if len(text) == 1 and i not in self.special.values():
                self.ends[i] = self.starts[i] = ((i, INFINITE),)
                self.ids[text] = i
        for whole, k in created.items():
            a, b = self.parts[whole]
            self.ends[whole] = (*((t, min(up, k)) for t, up in self.ends.get(b, ())), (whole, INFINITE))
            self.starts[whole] = (*((t, min(up, k)) for t, up in self.starts.get(a, ())), (whole, INFINITE))
            if self.bytes_of[a] in self.ids and self.bytes_of[b] in self.ids and self.holds(a, b, k):
                self.ids[self.bytes_of[whole]] = whole
        self.longest, self.size_of = max(map(len, self.ids)), [len(x) for x in self.bytes_of]
        #: lengths of the tokens that end in these bytes, longest first: by three bytes, and by two
        #: for ends that no token of three or more has
        self.long_ends: dict[bytes, list] = {}
        self.short_ends = {text: (2, 1) for text in self.ids if len(text) == 2}
        for text in sorted(self.ids, key=len, reverse=True):
            if len(text) > 2:
                found = self.long_ends.setdefault(text[-3:], [])
                if not found or found[-1] != len(text):
                    found.append(len(text))
        for end, found in self.long_ends.items():
            found.extend(self.short_ends.get(end[-2:], ONE))
        self.lookahead = self._lookahead(created)
        self.known: dict[int, bool] = {}
        self.words: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        self.machine = Transducer(self)

    def holds(self, a: int, b: int, before: int = INFINITE) -> bool:
        """Does the boundary between tokens a and b survive all merges of rank below `before`?

        A merge over the boundary happens if it comes due before either part is merged into
        its own token; of equal ranks the one further left comes first."""
        rank = self.rank
        for x, gone_x in self.ends[a]:
            for y, gone_y in self.starts[b]:
                r = rank.get((x, y), INFINITE)
                if r < before and r < gone_x and r <= gone_y:
                    return False
        return True

    def _lookahead(self, created: dict[int, int]) -> int:
        """Bytes after which nothing changes a token any more: the longest chain of merges of
        rising rank in which each contests, or builds on, the left part of the one before."""
        reach: dict[int, int] = {}
        for whole in sorted(created, key=created.get):
            a, b = self.parts[whole]
            here = len(self.bytes_of[a]) + max(len(self.bytes_of[b]), reach.get(b, 0))
            for t in (a, whole):
                reach[t] = max(reach.get(t, 0), here)
        return max(reach.values(), default=1)

    def remember(self, word: str, ids: bytes) -> None:
        """Two generations: words that come again move to the younger one, the rest are forgotten with the older."""
        if len(self.words) >= WORDS:
            self.older, self.words = self.words, {}
        self.words[word] = ids

    def survives(self, a: int, b: int) -> bool:
        key = a << 32 | b
        found = self.known.get(key)
        if found is None:
            if len(self.known) > 4 * WORDS:
                self.known.clear()
            found = self.known[key] = self.holds(a, b)
        return found


class Transducer:
    """Bytes in, stable tokens out; keeps a bounded number of bytes and states."""

    def __init__(self, merges: Merges):
        self.m, self.buffer, self.last, self.delay = merges, b"", [-1], 0

    def feed(self, data: bytes) -> list[int]:
        """Tokens that became stable. last[i] is the token that ends the prefix of i bytes."""
        m, keep = self.m, self.m.lookahead + self.m.longest
        out: list[int] = []
        for start in range(0, len(data), keep):
            self._step(data[start : start + keep])
            if len(self.buffer) > keep:
                out += self._emit()
        return out

    def _step(self, data: bytes) -> None:
        m, last, i = self.m, self.last, len(self.buffer)
        ids, known, long_ends, short_ends = m.ids, m.known, m.long_ends, m.short_ends
        self.buffer = text = self.buffer + data
        while i < len(text):
            i += 1
            if i > 2:
                sizes = long_ends.get(text[i - 3 : i]) or short_ends.get(text[i - 2 : i], ONE)
            else:
                sizes = short_ends.get(text[:i], ONE)
            for size in sizes:
                if size > i:
                    continue
                t = ids.get(text[i - size : i])
                if t is not None:
                    before = last[i - size]
                    if before < 0:
                        if i == size:
                            break
                        continue
                    ok = known.get(before << 32 | t)
                    if ok is None:
                        ok = m.survives(before, t)
                    if ok:
                        break
            else:
                raise ValueError("a byte has no token")
            last.append(t)

    def _path(self, end: int) -> list[int]:
        """Places of the token ends on the way back from `end`, nearest first."""
        places, size = [], self.m.bytes_of
        while end > 0:
            places.append(end)
            end -= len(size[self.last[end]])
        return places

    def _emit(self) -> list[int]:
        """Later tokens start from one of the last `longest` states; what all of these descend from is stable."""
        n = len(self.buffer)
        common = None
        for live in range(max(1, n - self.m.longest + 1), n + 1):
            path = self._path(live)
            common = set(path) if common is None else common.intersection(path)
            if not common:
                return []
        stable = max(common)
        self.delay = max(self.delay, n - stable)
        tokens = [self.last[p] for p in reversed(self._path(stable))]
        # the last stable token stays as the state that later ones are checked against
        self.buffer, self.last = self.buffer[stable:], [self.last[stable], *self.last[stable + 1 :]]
        return tokens

    def flush(self) -> list[int]:
        tokens = [self.last[p] for p in reversed(self._path(len(self.buffer)))]
        self.buffer, self.last = b"", [-1]
        return tokens


@functools.lru_cache(maxsize=2)
def merges(path: str) -> Merges:
    return Merges(path)


def pieces(text: str):
    """The text in pieces of about CHUNK characters that end where a single space stands
    between two other characters; no cut of the text crosses such a place."""
    start, n = 0, len(text)
    while start < n:
        end = start + CHUNK
        while end < n:
            at = text.rfind(" ", start + 1, end)
            while at > start and (ONE_SPACE.match(text[at - 1]) or ONE_SPACE.match(text[at + 1])):
                at = text.rfind(" ", start + 1, at)
            if at > start:
                end = at
                break
            end += CHUNK
        yield text[start:end]
        start = end


def packed(ids: list[int]) -> bytes:
    """Ids as little-endian unsigned 32-bit integers."""
    out = array.array("I", ids)
    if sys.byteorder == "big":
        out.byteswap()
    return out.tobytes()


def word_ids(m: Merges, word: str) -> bytes:
    """The ids of a word of at most 2 CHUNK characters; the transducer runs for every word not met lately."""
    parts = [word] if word[1:].isalpha() and (word[0] == " " or word[0].isalpha()) else CUT.findall(word)
    if len(parts) > 1:
        found = b"".join([m.words.get(x) or word_ids(m, x) for x in parts])
    else:
        found = m.older.get(word)
        if found is None:
            machine = m.machine
            found = packed(machine.feed(word.encode()) + machine.flush())
    if len(word) <= 64:
        m.remember(word, found)
    return found


def word_chunks(m: Merges, word: str):
    """The ids of a word of any length, as they become stable."""
    machine = Transducer(m)
    for k in range(0, len(word), CHUNK):
        yield packed(machine.feed(word[k : k + CHUNK].encode()))
    yield packed(machine.flush())


def spaced_words(piece: str) -> list[str]:
    """The piece cut before each single space; as one where spaces meet or stand at an end."""
    if SPACES.search(piece) or ONE_SPACE.match(piece[-1]):
        return CUT.findall(piece)
    first, *rest = piece.split(" ")
    rest = [" " + x for x in rest]
    return [first, *rest] if first else rest


def encode_chunks(m: Merges, text: str | None):
    """The ids of a text, as byte strings of little-endian unsigned 32-bit integers."""
    runs = [text or ""]
    for name in m.special:
        runs = [y for x in runs for y in ([x] if x in m.special else around(x, name))]
    for run in runs:
        if run in m.special:
            yield np.array([m.special[run]], dtype="<u4").tobytes()
            continue
        for piece in pieces(run):
            if len(piece) <= 2 * CHUNK:
                yield b"".join([m.words.get(w) or word_ids(m, w) for w in spaced_words(piece)])
                continue
            for found in CUT.finditer(piece):  # no single space to cut at: one word at a time
                word = found.group()
                if len(word) <= CHUNK:
                    yield m.words.get(word) or word_ids(m, word)
                else:
                    yield from word_chunks(m, word)


def around(text: str, name: str) -> list[str]:
    out = []
    for k, x in enumerate(text.split(name)):
        out += [name] * (k > 0) + [x]
    return [x for x in out if x]


class TextMachine:
    """Ids in, text out: holds back the bytes of a character until it is whole."""

    def __init__(self, m: Merges):
        self.m, self.state = m, codecs.getincrementaldecoder("utf-8")(errors="replace")

    def feed(self, ids: bytes, last: bool = False) -> str:
        table = self.m.bytes_of
        return self.state.decode(b"".join(map(table.__getitem__, np.frombuffer(ids, dtype="<u4").tolist())), last)


def encode(df: DataFrame, path: str, text: str = "text", ids: str = "ids") -> DataFrame:
    """df with an array column of token ids."""

    @F.pandas_udf("array<int>")
    def run(texts):
        m = merges(path)
        return texts.map(lambda x: np.frombuffer(b"".join(encode_chunks(m, x)), dtype="<u4").astype("i4"))

    return df.withColumn(ids, run(F.coalesce(F.col(text), F.lit(""))))


def decode(df: DataFrame, path: str, ids: str = "ids", text: str = "text") -> DataFrame:
    """df with the text of a column of token ids."""

    @F.pandas_udf("string")
    def run(rows):
        m = merges(path)
        return rows.map(lambda x: TextMachine(m).feed(np.asarray([] if x is None else x, dtype="<u4").tobytes(), True))

    return df.withColumn(text, run(F.col(ids)))


def digests(df: DataFrame, path: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: number of ids, digest of the ids, digest of the text they decode to.

    Ids stream from the encoder through both digests and the decoder; neither the ids nor
    the decoded text of a document is ever held whole."""

    def run(batches):
        m = merges(path)
        for batch in batches:
            out = []
            for t in batch.column(1).to_pylist():
                n, of_ids, of_text, machine = 0, hashlib.sha256(), hashlib.sha256(), TextMachine(m)
                for chunk in encode_chunks(m, t):
                    n += len(chunk) // 4
                    of_ids.update(chunk)
                    of_text.update(machine.feed(chunk).encode())
                of_text.update(machine.feed(b"", True).encode())
                out.append((n, of_ids.hexdigest(), of_text.hexdigest()))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array(list(c), t) for c, t in zip(zip(*out) if out else [()] * 3, (pa.int64(), pa.string(), pa.string())))],
                names=[key, "n_tokens", "ids_sha256", "decoded_sha256"],
            )

    kind = df.schema[key].dataType.simpleString()
    return df.select(key, text).mapInArrow(run, f"`{key}` {kind}, n_tokens bigint, ids_sha256 string, decoded_sha256 string")
