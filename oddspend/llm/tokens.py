"""Token ids for operators that only need them, not the streaming encoder.

The same vocabulary as in `bpe`, run by tiktoken on whole runs of text; ids are those of
the tokenizers library, special tokens written in a text included.
"""

import array
import functools
import json
import re
import sys

import numpy as np
import tiktoken

from oddspend.llm import bpe

#: CUT without its look-ahead, which only matters where white space meets white space.
PLAIN_CUT = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^" + bpe.SPACE + r"\p{L}\p{N}]+|[" + bpe.SPACE + "]"
SPACES = re.compile(r"\s\s")  # all white space of CUT, and a little more


class Ids:
    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            data = json.load(file)
        byte = bpe.printable_bytes()
        self.special = {x["content"]: x["id"] for x in data.get("added_tokens", [])}
        vocab = data["model"]["vocab"]
        for k, pair in enumerate(data["model"]["merges"]):
            whole = "".join(pair) if isinstance(pair, list) else pair.replace(" ", "", 1)
            if vocab[whole] - k != len(byte):
                raise ValueError("ids must follow the order of the merges")
        ranks = {bytes(byte[c] for c in text): i for text, i in vocab.items() if text not in self.special}
        self.full, self.plain = (
            tiktoken.Encoding("own", pat_str=cut, mergeable_ranks=ranks, special_tokens={}).encode_ordinary for cut in (bpe.CUT.pattern, PLAIN_CUT)
        )

    def chunks(self, text: str | None):
        """Lists of ids of one piece of the text after another; null is the empty text."""
        runs = [text or ""]
        for name in self.special:
            if name in runs[0] or len(runs) > 1:
                runs = [y for x in runs for y in ([x] if x in self.special else bpe.around(x, name))]
        for run in runs:
            if run in self.special:
                yield [self.special[run]]
                continue
            for piece in bpe.pieces(run):
                yield (self.full if SPACES.search(piece) else self.plain)(piece)

    def encode(self, text: str | None) -> bytes:
        """The ids as little-endian unsigned 32-bit integers."""
        out = array.array("I")
        for ids in self.chunks(text):
            out.extend(ids)
        return out.tobytes() if sys.byteorder == "little" and out.itemsize == 4 else np.array(out, dtype="<u4").tobytes()

    def count(self, text: str | None) -> int:
        return sum(map(len, self.chunks(text)))


@functools.lru_cache(maxsize=2)
def ids(path: str) -> Ids:
    return Ids(path)
