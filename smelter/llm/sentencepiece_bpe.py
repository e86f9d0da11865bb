"""SentencePiece (merge-type) encoding and decoding without merging.

``PieceTable`` reads a piece model file and encodes by a prefix table: every
prefix of a merge-encoded text has one last token, so the table needs one id
per prefix.  A token that an automaton finds ending at a prefix is that last
token exactly if it may stand after the last token of the prefix before it;
``compatible`` decides this by undoing merges across the seam.  The ids are
then read from the table backwards, from the full text to the empty prefix.

White space never joins the end of a piece to the begin of the next in these
models (``▁`` only leads), so a text is cut in front of each run of ``▁`` and
a distinct cut is encoded once as long as it stays in the Python worker's
memo: two generations of ``MEMO_CUTS`` cuts, long cuts (over ``MEMO_CHARS``)
not kept.  Characters outside the vocabulary become byte pieces.

Defined results: null counts as empty (the end id alone); texts of any length
are encoded whole; extra columns pass through ``encode_documents`` untouched.
"""

from __future__ import annotations

import hashlib
import re
import struct
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

SPACE = "▁"
MEMO_CUTS, MEMO_CHARS = 150_000, 200
#: Seams remembered per worker, and documents held as Python objects at once.
SEAMS, ROWS_AT_ONCE = 400_000, 200

#: Piece types and field numbers of the model file's messages.
NORMAL, UNKNOWN, CONTROL, USER_DEFINED, BYTE, UNUSED = 1, 2, 3, 4, 6, 5
_CUTS = re.compile(f"{SPACE}*[^{SPACE}]+|{SPACE}+")


def _fields(data: bytes) -> Iterator[tuple[int, object]]:
    """(number, value) of each field of a protocol-buffer message."""
    at, end = 0, len(data)

    def varint() -> int:
        nonlocal at
        value = shift = 0
        while True:
            byte = data[at]
            at += 1
            value |= (byte & 127) << shift
            shift += 7
            if byte < 128:
                return value

    while at < end:
        tag = varint()
        kind = tag & 7
        if kind == 0:
            value: object = varint()
        else:
            size = varint() if kind == 2 else {1: 8, 5: 4}[kind]
            value = data[at:at + size]
            at += size
        yield tag >> 3, value


class PieceTable:
    """A merge-type piece model: ``encode`` to ids, ``decode`` back to text."""

    def __init__(self, model: bytes):
        pieces: list[tuple[str, float, int]] = []
        spec: dict[int, object] = {}
        normal: dict[int, object] = {}
        for field, value in _fields(model):
            if field == 1:
                piece = dict(_fields(value))
                pieces.append((piece[1].decode(), struct.unpack("<f", piece.get(2, b"\0\0\0\0"))[0], piece.get(3, NORMAL)))
            elif field == 2:
                spec = dict(_fields(value))
            elif field == 3:
                normal = dict(_fields(value))
        self.pieces = [p for p, _, _ in pieces]
        self.kinds = [k for _, _, k in pieces]
        self.ids = {p: i for i, (p, _, k) in enumerate(pieces) if k == NORMAL}
        if spec.get(3, 1) != 2 or normal.get(1) != b"identity" or normal.get(2):
            raise ValueError("only merge-type models with the identity normaliser are supported")
        if not spec.get(35, 0) or any(k in (USER_DEFINED, UNUSED) for k in self.kinds):
            raise ValueError("only models with byte pieces and without user-defined or unused pieces are supported")
        if normal.get(4, 1) or not normal.get(3, 1) or not normal.get(5, 1):
            raise ValueError("only models that keep white space and add a leading space are supported")
        if any(SPACE in p.lstrip(SPACE) or any(c not in self.ids for c in p) for p in self.ids):
            raise ValueError("a piece joins a word to the white space after it, or has a character without a piece")
        self.end = spec.get(42, 2)
        byte_ids = {int(p[3:5], 16): i for i, (p, k) in enumerate(zip(self.pieces, self.kinds, strict=True)) if k == BYTE}
        self.byte_ids, self.byte_of = byte_ids, {i: b for b, i in byte_ids.items()}
        # merges go by score, highest first; a character comes before any merge
        order = {score: rank for rank, score in enumerate(sorted({-s for _, s, _ in pieces}))}
        self.rank = [order[-s] if len(p) > 1 else -1 for p, s, _ in pieces]
        self.names = [str(i) for i in range(len(pieces))]
        self.last_special = max(i for i, k in enumerate(self.kinds) if k != NORMAL)
        self.automaton = ahocorasick.Automaton()
        for piece, i in self.ids.items():
            if len(piece) > 1:
                self.automaton.add_word(piece, (len(piece), i))
        self.automaton.make_automaton()
        self.halves: dict[int, tuple[int, int] | None] = {}
        self.seams: dict[int, bool] = {}
        self.sound: set[int] = set()
        self.memo: dict[str, tuple[str, str]] = {}
        self.older: dict[str, tuple[str, str]] = {}

    def merges(self, text: str) -> tuple[list[int], list[tuple[int, int]]]:
        """The tokens of a short text by plain merging, and the merges in order."""
        tokens, done = [self.ids[c] for c in text], []
        while True:
            best = min(((self.rank[m], i, m) for i in range(len(tokens) - 1)
                        if (m := self.ids.get(self.pieces[tokens[i]] + self.pieces[tokens[i + 1]])) is not None),
                       default=None)
            if best is None:
                return tokens, done
            _, i, m = best
            done.append((tokens[i], tokens[i + 1]))
            tokens[i:i + 2] = [m]

    def half(self, token: int) -> tuple[int, int] | None:
        """The two tokens merged into ``token`` last; None for a piece that
        merging its own characters does not give, which never occurs."""
        if token not in self.halves:
            tokens, done = self.merges(self.pieces[token])
            self.halves[token] = done[-1] if tokens == [token] and done else None
        return self.halves[token]

    def compatible(self, left: int, right: int) -> bool:
        """Whether the joint text of two tokens is encoded as these two."""
        key = left << 20 | right
        known = self.seams.get(key)
        if known is None:
            if len(self.seams) >= SEAMS:
                self.seams.clear()
            known = self.seams[key] = self._compatible(left, right)
        return known

    def _compatible(self, left: int, right: int) -> bool:
        """Undo the two tokens' merges, latest first, and ask at each stage
        whether the parts at the seam would have merged before it came about."""
        pieces, rank, given = self.pieces, self.rank, [left, right]
        before = len(pieces) + 1  # a seam merge of a lower rank comes earlier
        while True:
            across = self.ids.get(pieces[left] + pieces[right])
            if across is not None and rank[across] < before:
                return False
            if rank[left] < 0 and rank[right] < 0:
                return True
            # Of the two last merges the one of higher rank came later; of
            # equal ranks the right one, as merging goes from left to right.
            if rank[left] > rank[right]:
                whole, left = left, self.half(left)[1]
                part, before = left, rank[whole]
            else:
                whole, right = right, self.half(right)[0]
                part, before = right, rank[whole] + 1
            if rank[part] >= rank[whole]:  # then ranks do not tell the order: merge the joint text
                return self.merges(pieces[given[0]] + pieces[given[1]])[0] == given

    def encode_cut(self, cut: str) -> list[int]:
        """Ids of one cut.  ``last[i]`` is the last token of the prefix of
        length i, -1 for a character without a piece."""
        n, ids, seams, sound = len(cut), self.ids, self.seams, self.sound
        last: list[int | None] = [None] * (n + 1)
        done = 0
        for at, (size, token) in self.automaton.iter(cut):
            while done < at:  # no longer token fits there: the character itself
                if last[done + 1] is None:
                    last[done + 1] = ids.get(cut[done], -1)
                done += 1
            # a prefix has one last token, so the first that fits is it
            if last[at + 1] is None:
                begin = at + 1 - size
                if begin == 0 or (before := last[begin]) < 0:
                    fits = True
                elif (fits := seams.get(before << 20 | token)) is None:
                    fits = self.compatible(before, token)
                if fits and (token in sound or self.half(token)):
                    sound.add(token)
                    last[at + 1] = token
        while done < n:
            if last[done + 1] is None:
                last[done + 1] = ids.get(cut[done], -1)
            done += 1
        out, i, pieces = [], n, self.pieces
        while i:
            token = last[i]
            if token < 0:
                i -= 1
                out.extend(self.byte_ids[b] for b in reversed(cut[i].encode()))
            else:
                out.append(token)
                i -= len(pieces[token])
        out.reverse()
        return out

    def decode(self, ids: list[int]) -> str:
        """Text of ids: byte pieces as UTF-8 (each byte that is not part of a
        character becomes U+FFFD), control pieces as nothing, one leading
        space dropped."""
        if ids and min(ids) > self.last_special:
            return "".join([self.pieces[i] for i in ids]).removeprefix(SPACE).replace(SPACE, " ")
        out: list[str] = []
        held = bytearray()
        begun = False
        for i in ids:
            if i in self.byte_of:
                held.append(self.byte_of[i])
                begun = True
                continue
            out.append(_characters(held))
            held.clear()
            if self.kinds[i] != CONTROL:
                piece = " \u2047 " if self.kinds[i] == UNKNOWN else self.pieces[i]
                out.append((piece if begun else piece.removeprefix(SPACE)).replace(SPACE, " "))
                begun = True
        out.append(_characters(held))
        return "".join(out)

    def cuts(self, text: str) -> list[str]:
        return _CUTS.findall(SPACE + text.replace(" ", SPACE)) if text else []

    def encode(self, text: str) -> list[int]:
        return [i for cut in self.cuts(text) for i in self.encode_cut(cut)] + [self.end]

    def _parts(self, text: str) -> list[str]:
        """The cuts of a text; where single spaces part them, the bare words,
        each standing for the cut of one leading space and the word."""
        if text and "  " not in text and SPACE not in text and text[0] != " " and text[-1] != " ":
            return text.split(" ")
        return self.cuts(text)

    def _entry(self, part: str) -> tuple[str, str]:
        """Ids as text and the decoded text of a part, from either generation
        of the memo or anew."""
        entry = self.older.get(part)
        if entry is None:
            ids = self.encode_cut(part if part[0] == SPACE else SPACE + part)
            # every cut starts with white space, of which decode drops one
            entry = " ".join([self.names[i] for i in ids]), " " + self.decode(ids)
        if len(part) <= MEMO_CHARS:
            self.memo[part] = entry
        return entry

    def encoded(self, text: str) -> tuple[str, str]:
        """The ids, as decimals joined by a space, and the decoded text."""
        if len(self.memo) > MEMO_CUTS:
            self.memo, self.older = {}, self.memo
        memo, parts = self.memo, self._parts(text)
        new = {p: self._entry(p) for p in set(parts).difference(memo)}
        found = [memo.get(p) or new[p] for p in parts] if new else [memo[p] for p in parts]
        return " ".join([e[0] for e in found] + [str(self.end)]), "".join([e[1] for e in found])[1:]


def _sha256(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def _characters(data: bytes) -> str:
    if not data:
        return ""
    out, i = [], 0
    while i < len(data):
        size = 1 if data[i] < 0x80 else 2 if data[i] >> 5 == 6 else 3 if data[i] >> 4 == 14 else 4
        try:
            out.append(bytes(data[i:i + size]).decode())
            i += size
        except UnicodeDecodeError:
            out.append("\ufffd")
            i += 1
    return "".join(out)


_tables: dict[str, PieceTable] = {}


def table_of(model: bytes) -> PieceTable:
    """The worker's table for a model; later tasks of the worker find it built."""
    key = hashlib.sha256(model).hexdigest()
    if key not in _tables:
        _tables[key] = PieceTable(model)
    return _tables[key]


def encode_documents(docs: DataFrame, model_path: str, id: str = "doc_id", text: str = "text",
                     with_ids: bool = False) -> DataFrame:
    """One row per document: id, n_tokens, ids_sha256, decoded_sha256 and, on
    request, the ids themselves.  ``model_path`` is read on the driver and
    sent along once (a vocabulary file, some hundred kilobytes)."""
    with open(model_path, "rb") as file:
        model = docs.sparkSession.sparkContext.broadcast(file.read())

    def run(batches):
        table = table_of(model.value)
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS_AT_ONCE):
                part = batch.slice(at, ROWS_AT_ONCE)
                found = [table.encoded(t or "") for t in part.column("text").to_pylist()]
                columns = [part.column("id"), pa.array([ids.count(" ") + 1 for ids, _ in found], pa.int64()),
                           pa.array([_sha256(ids) for ids, _ in found]), pa.array([_sha256(text) for _, text in found])]
                if with_ids:
                    columns.append(pa.array([np.fromstring(ids, np.int32, sep=" ") for ids, _ in found], pa.list_(pa.int32())))
                yield pa.RecordBatch.from_arrays(columns, names)

    rows = docs.select(docs[id].alias("id"), docs[text].cast("string").alias("text"))
    names = ["id", "n_tokens", "ids_sha256", "decoded_sha256"] + ["ids"] * with_ids
    schema = T.StructType([rows.schema["id"], T.StructField("n_tokens", T.LongType()),
                           T.StructField("ids_sha256", T.StringType()), T.StructField("decoded_sha256", T.StringType()),
                           *([T.StructField("ids", T.ArrayType(T.IntegerType()))] * with_ids)])
    return rows.mapInArrow(run, schema).withColumnRenamed("id", id)
