"""Exact encoding with a merge-type SentencePiece model by backtracking, and decoding.

Merging gives a text t1 .. tn exactly if every two neighbours are what merging gives of them alone:
no merge inside a token depends on its neighbours, and the first merge across a border would also
happen in the two tokens beside it. So a prefix of a text has one valid encoding at most. The
encoder takes the longest token at each position (one pass of an Aho-Corasick automaton), checks it
against the token before it by merging the two again, and goes on to shorter ones; where none fits,
the position has failed for good, whatever comes before it, and is entered in a bit field. Merging
two tokens again comes down to their border: each token's own merges are known, and undoing them
from the last one back shows all pairs of symbols that ever met there.

Texts are cut where no token of the vocabulary reaches across: before each run of spaces, and around
control characters without a token. Each distinct stretch is encoded once for a batch.
"""

from __future__ import annotations

import hashlib
import re
import struct
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from functools import lru_cache

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from plateflow.llm.frames import append, texts

#: Stands for a space inside tokens.
SPACE = "▁"
#: What an unknown token is decoded to.
UNKNOWN = " ⁇ "
#: Kinds of tokens in a model file.
NORMAL, UNKNOWN_KIND, CONTROL, BYTE = 1, 2, 3, 6
#: Results remembered between batches; bounds memory, not the result.
REMEMBERED = 400_000


@dataclass(frozen=True)
class PieceModel:
    """The content of a model file; ``load`` builds its tables once per worker."""

    content: bytes

    def load(self) -> Pieces:
        return _tables(self.content)


def read_model(path: str) -> PieceModel:
    """A model file, read on the driver; the content travels with the job. Raises ValueError unless it is of the
    merge type with byte fallback, identity normalisation and a space in front."""
    with open(path, "rb") as file:
        model = PieceModel(file.read())
    model.load()
    return model


@lru_cache(maxsize=2)
def _tables(content: bytes) -> Pieces:
    return Pieces(content)


def fields(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    """Numbers and values of the fields of a protocol buffer message."""
    at = 0

    def varint() -> int:
        nonlocal at
        value = shift = 0
        while True:
            byte = data[at]
            at += 1
            value |= (byte & 127) << shift
            if byte < 128:
                return value
            shift += 7

    while at < len(data):
        key = varint()
        kind = key & 7
        if kind == 0:
            yield key >> 3, varint()
            continue
        size = {1: 8, 5: 4}.get(kind) or varint()
        yield key >> 3, data[at:at + size]
        at += size


class Pieces:
    """Tables of a model, and the encoder of single stretches."""

    def __init__(self, content: bytes) -> None:
        #: Token of each id, its kind, and the order of merging (smaller first) of the normal ones.
        self.token_of: list[str] = []
        self.kinds: list[int] = []
        self.order: dict[str, float] = {}
        self.ids: dict[str, int] = {}
        trainer: dict[int, int | bytes] = {}
        normalizer: dict[int, int | bytes] = {}
        for field, value in fields(content):
            if field == 1:
                entry = dict(fields(value))
                token, kind = entry[1].decode("utf-8"), entry.get(3, NORMAL)
                if kind == NORMAL:
                    self.ids[token] = len(self.token_of)
                    self.order[token] = -struct.unpack("<f", entry[2])[0] if 2 in entry else 0.0
                elif kind not in (UNKNOWN_KIND, CONTROL, BYTE):
                    raise ValueError("tokens defined by users and unused tokens are not supported")
                self.token_of.append(token)
                self.kinds.append(kind)
            elif field == 2:
                trainer = dict(fields(value))
            elif field == 3:
                normalizer = dict(fields(value))
        self.bytes = {i: int(t[3:5], 16) for i, t in enumerate(self.token_of) if self.kinds[i] == BYTE}
        if trainer.get(3) != 2 or len(self.bytes) != 256:
            raise ValueError("not a merge-type model with byte fallback")
        if normalizer.get(2) or not normalizer.get(3, 1) or normalizer.get(4, 1) or not normalizer.get(5, 1) or trainer.get(24):
            raise ValueError("only identity normalisation with a space in front is supported")
        self.begin, self.end = trainer.get(41, 1), trainer.get(42, 2)
        self.byte_ids = [0] * 256
        for i, byte in self.bytes.items():
            self.byte_ids[byte] = i
        #: Of each token its id as little-endian 32-bit integer, and what the id is decoded to.
        self.packed = {t: struct.pack("<I", i) for t, i in self.ids.items()}
        self.plain = {t: t.replace(SPACE, " ") for t in self.ids}
        # A letter inside a token takes part in merges even where it is no token itself.
        letters = {c for token in self.order for c in token}
        self.automaton = ahocorasick.Automaton()
        for token in letters | self.order.keys():
            self.automaton.add_word(token, len(token))
        self.automaton.make_automaton()
        self.units = letters | self.order.keys()
        if any(re.search(f"[^{SPACE}]{SPACE}", token) for token in self.order):
            self._stretches = None
        else:
            alone = "".join(chr(i) for i in range(32) if chr(i) not in letters)
            alone = re.escape(alone)
            self._stretches = re.compile(
                f"{SPACE}*[^{SPACE}{alone}]+|{SPACE}+" + f"|[{alone}]" * bool(alone)).findall
        self._splits: dict[str, tuple[str, str] | None] = {}
        self._whole: dict[str, bool] = {}
        self._fits: dict[tuple[str, str], bool] = {}
        self._shorter: dict[str, int] = {}

    def stretches(self, text: str) -> list[str]:
        """A whole text with its spaces written out and one in front, cut where no token reaches across."""
        if not text:
            return []
        text = SPACE + text.replace(" ", SPACE)
        return self._stretches(text) if self._stretches else [text]

    def merge(self, text: str) -> list[str]:
        """What merging gives: the best pair first, the leftmost of equal ones."""
        parts, order = list(text), self.order
        while True:
            best, at = None, 0
            for i in range(len(parts) - 1):
                rank = order.get(parts[i] + parts[i + 1])
                if rank is not None and (best is None or rank < best):
                    best, at = rank, i
            if best is None:
                return parts
            parts[at:at + 2] = [parts[at] + parts[at + 1]]

    def _split(self, token: str) -> tuple[str, str] | None:
        """The two symbols whose merge makes ``token`` in the end, or None if it is not made of its letters by merges
        of ever later order."""
        parts, order, last = list(token), self.order, None
        while len(parts) > 1:
            best, at = None, 0
            for i in range(len(parts) - 1):
                rank = order.get(parts[i] + parts[i + 1])
                if rank is not None and (best is None or rank < best):
                    best, at = rank, i
            if best is None:
                return None
            if len(parts) == 2:
                last = parts[0], parts[1]
            parts[at:at + 2] = [parts[at] + parts[at + 1]]
        return last if all(len(x) == 1 or order[x] < order[token] and self.split(x) for x in last) else None

    def split(self, token: str) -> tuple[str, str] | None:
        if token not in self._splits:
            self._splits[token] = self._split(token)
        return self._splits[token]

    def whole(self, token: str) -> bool:
        """Whether merging the letters of ``token`` gives it."""
        known = self._whole.get(token)
        if known is None:
            known = self._whole[token] = len(token) == 1 or self.split(token) is not None or self.merge(token) == [token]
        return known

    def fits(self, left: str, right: str) -> bool:
        """Whether merging the letters of both tokens gives these two."""
        a, b, order, splits = left, right, self.order, self._splits
        if len(a) > 1 and not self.split(a) or len(b) > 1 and not self.split(b):
            return self.merge(left + right) == [left, right]
        rank = order.get(a + b)
        while rank is None:
            # Undo the later of the two merges; of equal ones the right one came later.
            rank_a = order[a] if len(a) > 1 else None
            rank_b = order[b] if len(b) > 1 else None
            if rank_a is not None and (rank_b is None or rank_a > rank_b):
                a = splits[a][1]
                rank = order.get(a + b)
                if rank is not None and rank >= rank_a:  # the merge inside the left token came first
                    rank = None
            elif rank_b is not None:
                b = splits[b][0]
                rank = order.get(a + b)
                if rank is not None and rank > rank_b:
                    rank = None
            else:
                return True
        return False

    def shorter(self, token: str) -> int:
        """The length of the longest token that ``token`` begins with, itself excepted; 0 if there is none."""
        known = self._shorter.get(token)
        if known is None:
            known = self._shorter[token] = next(
                (size for size in range(len(token) - 1, 0, -1) if token[:size] in self.units), 0)
        return known

    def tokens(self, stretch: str) -> list[str]:
        """The tokens of a stretch; a letter that no token holds stands alone."""
        if stretch in self.order and self.whole(stretch):
            return [stretch]
        longest = [0] * len(stretch)
        for last, size in self.automaton.iter(stretch):
            longest[last - size + 1] = size  # later matches from the same place are longer
        if 0 not in longest:
            return self._between(stretch, 0, len(stretch), longest)
        out: list[str] = []
        at = 0
        while at < len(stretch):
            if not longest[at]:
                out.append(stretch[at])
                at += 1
                continue
            stop = at
            while stop < len(stretch) and longest[stop]:
                stop += 1
            out += self._between(stretch, at, stop, longest)
            at = stop
        return out

    def _between(self, text: str, low: int, high: int, longest: list[int]) -> list[str]:
        """The tokens of a part of ``text`` all of whose letters are known."""
        failed = bytearray((high - low >> 3) + 1)
        known, compatible = self._whole, self._fits
        out: list[str] = []
        at, size, last = low, longest[low], None
        while at < high:
            while size:
                token = text[at:at + size]
                place = at + size - low
                if not failed[place >> 3] >> (place & 7) & 1 and (known.get(token) or self.whole(token)):
                    if last is None:
                        break
                    pair = last, token
                    fit = compatible.get(pair)
                    if fit is None:
                        if len(compatible) >= REMEMBERED:
                            compatible.clear()
                        fit = compatible[pair] = self.fits(last, token)
                    if fit:
                        break
                size = self.shorter(token)
            if size:
                out.append(token)
                last = token
                at += size
                size = longest[at] if at < high else 0
            else:
                failed[at - low >> 3] |= 1 << (at - low & 7)
                token = out.pop()
                last = out[-1] if out else None
                at -= len(token)
                size = self.shorter(token)
        return out

    def encode(self, stretch: str) -> list[int]:
        """Ids of a stretch; what has no token becomes its bytes."""
        ids = []
        for token in self.tokens(stretch):
            known = self.ids.get(token)
            if known is not None:
                ids.append(known)
            else:
                ids += [self.byte_ids[b] for b in token.encode("utf-8")]
        return ids

    def spell(self, ids: Sequence[int]) -> str:
        """The text of some ids, spaces written as spaces; bytes that are no UTF-8 each give U+FFFD."""
        out, raw = [], bytearray()
        for i in ids:
            byte = self.bytes.get(i)
            if byte is not None:
                raw.append(byte)
                continue
            if raw:
                out.append(from_bytes(bytes(raw)))
                raw.clear()
            if self.kinds[i] == NORMAL:
                out.append(self.token_of[i].replace(SPACE, " "))
            elif self.kinds[i] == UNKNOWN_KIND:
                out.append(UNKNOWN)
        if raw:
            out.append(from_bytes(bytes(raw)))
        return "".join(out)

    def decode(self, ids: Sequence[int]) -> str:
        """The text of a whole encoding: without the space put in front, control tokens silent."""
        ids = [i for i in ids if i is not None and 0 <= i < len(self.kinds)]
        first = next((i for i in ids if self.kinds[i] != CONTROL), None)
        text = self.spell(ids)
        if first is not None and self.kinds[first] == NORMAL and self.token_of[first].startswith(SPACE):
            return text[1:]
        return text


def from_bytes(raw: bytes) -> str:
    """UTF-8 text; each byte outside a whole letter gives U+FFFD."""
    out, at = [], 0
    while at < len(raw):
        for size in (1, 2, 3, 4):
            try:
                out.append(raw[at:at + size].decode("utf-8"))
                at += size
                break
            except UnicodeDecodeError:
                pass
        else:
            out.append("�")
            at += 1
    return "".join(out)


class Remembered(dict):
    """Ids (little-endian 32-bit) and text of stretches; forgets all between batches once there are many."""

    def __init__(self, pieces: Pieces) -> None:
        self.pieces = pieces

    def __missing__(self, stretch: str) -> tuple[bytes, str]:
        pieces = self.pieces
        tokens = pieces.tokens(stretch)
        try:
            found = b"".join([pieces.packed[t] for t in tokens]), "".join([pieces.plain[t] for t in tokens])
        except KeyError:  # bytes stand for a letter
            ids = pieces.encode(stretch)
            found = np.array(ids, "<u4").tobytes(), pieces.spell(ids)
        self[stretch] = found
        return found

    def trim(self) -> None:
        if len(self) > REMEMBERED:
            self.clear()


def encode(docs: DataFrame, model: PieceModel, text: str = "text", keep: Sequence[str] = (),
           begin: bool = True, end: bool = True) -> DataFrame:
    """``keep`` columns, ``ids`` array<int>: the tokens of each whole text, with the begin and end ids asked for.

    Null counts as the empty text, which has these two ids alone. Texts of any length are encoded
    whole, repeated rows each; an empty table gives an empty one. A kept column ``ids`` is replaced.
    """

    def make():
        pieces = model.load()
        known = Remembered(pieces)
        head, tail = ([pieces.begin] if begin else []), ([pieces.end] if end else [])

        def compute(columns):
            known.trim()
            rows = []
            for value in texts(columns[0]):
                ids = np.frombuffer(b"".join([known[s][0] for s in pieces.stretches(value)]), "<u4")
                rows.append(np.concatenate([head, ids, tail]).astype(np.int32))
            return [pa.array(rows, pa.list_(pa.int32()))]

        return compute

    return append(docs, [text], "ids array<int>", make, keep)


def decode(encoded: DataFrame, model: PieceModel, ids: str = "ids", keep: Sequence[str] = ()) -> DataFrame:
    """``keep`` columns, ``decoded`` string. Control ids give nothing, the unknown id its mark; the space put in front
    goes. Ids that the model does not have, and nulls, are passed over; a null list gives the empty text."""

    def make():
        pieces = model.load()

        def compute(columns):
            return [[pieces.decode(row or ()) for row in columns[0].to_pylist()]]

        return compute

    return append(encoded, [ids], "decoded string", make, keep)


def round_trip(docs: DataFrame, model: PieceModel, text: str = "text", keep: Sequence[str] = ()) -> DataFrame:
    """Encode every whole text with begin and end ids and decode it again, as digests.

    Returns the ``keep`` columns and ``n_tokens`` long (all ids), ``ids_sha256`` (the ids as
    little-endian unsigned 32-bit integers), ``decoded_sha256`` (UTF-8 of the decoded text). Null
    counts as empty; repeated rows each have their result; an empty table gives an empty result. A
    kept column named like an output is replaced by it.
    """

    def make():
        pieces = model.load()
        known = Remembered(pieces)
        head, tail = struct.pack("<I", pieces.begin), struct.pack("<I", pieces.end)

        def compute(columns):
            known.trim()
            counts, ids_digest, text_digest = [], [], []
            for value in texts(columns[0]):
                found = [known[s] for s in pieces.stretches(value)]
                ids = b"".join([head, *[f[0] for f in found], tail])
                # Bytes of one letter never lie in two stretches, so each is spelt alone.
                decoded = "".join([f[1] for f in found])
                if decoded.startswith(" "):  # the one put in front
                    decoded = decoded[1:]
                counts.append(len(ids) // 4)
                ids_digest.append(hashlib.sha256(ids).hexdigest())
                text_digest.append(hashlib.sha256(decoded.encode("utf-8")).hexdigest())
            return counts, ids_digest, text_digest

        return compute

    return append(docs, [text], "n_tokens long, ids_sha256 string, decoded_sha256 string", make, keep)
