"""SentencePiece encoding and decoding, giant documents by a max-plus scan over chunks.

A giant document (over GIANT characters) is cut into chunks. A *state* at a boundary is the token
that covers the character before it. A chunk's transfer matrix holds, for a state at its begin
and one at its end, the score of the best path between them in the max-plus semiring. For a
unigram model that is the sum of the pieces' scores. For a BPE model paths are restricted to
neighbours that the model itself leaves apart (encoding the two strings together gives the two
tokens again); scores are 0 for an allowed path and -inf for none, and there is exactly one
allowed path through a text: the model's encoding. Matrices are combined associatively, first in
blocks of BLOCK chunks, then over the blocks of a document (at most 512, as a string has at most
2 GB); the states that the path goes through are read off backwards, block by block, and every
chunk then emits its own tokens independently of the others.

Other documents are encoded by the library. For a BPE model whose pieces never hold the space
mark behind another character, texts are cut into units before their space marks, the different
units of a batch are encoded once, and ids are gathered in numpy; that gives the library's ids,
since no merge crosses such a place. Models of other kinds than these two are encoded by the
library, giant texts too.

Defined cases: null: null ids, null decoded; empty text: no ids. Repeated rows are encoded each;
a giant text that repeats is encoded once. A U+2581 in a text is encoded like a space, as the
library does. Between paths of a unigram model whose scores differ by less than float rounding
the scan may choose another than the library. Ids that decode to no valid UTF-8 give U+FFFD. An
empty table gives an empty result. Extra columns are kept, whatever their names.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from galley.llm.columns import fresh
from galley.session import cut_lineage

GIANT, CHUNK, BLOCK = 48_000, 16_000, 256
#: A boundary moves to the next end of a word within so many characters.
SNAP = 256
#: Units that a worker remembers, the bytes of one at most, and the ids of all at most.
MEMO, MEMO_LENGTH, MEMO_IDS = 1 << 16, 48, 1 << 19
#: Rows that are encoded at once.
ROWS = 250
MARK = "▁"
_NEXT = re.compile(f"(?<=[^{MARK}])(?={MARK})")


def _varint(data: bytes, i: int) -> tuple[int, int]:
    value = shift = 0
    while True:
        byte = data[i]
        i += 1
        value |= (byte & 127) << shift
        shift += 7
        if byte < 128:
            return value, i


def _fields(data: bytes) -> Iterator[tuple[int, int, bytes | int, bytes]]:
    """(number, wire type, value, raw bytes) of a protobuf message."""
    i = 0
    while i < len(data):
        begin = i
        tag, i = _varint(data, i)
        kind = tag & 7
        if kind == 0:
            value, i = _varint(data, i)
        elif kind == 2:
            size, i = _varint(data, i)
            value, i = data[i : i + size], i + size
        else:
            size = {1: 8, 5: 4}[kind]
            value, i = data[i : i + size], i + size
        yield tag >> 3, kind, value, data[begin:i]


def _encoded_size(n: int) -> bytes:
    out = bytearray()
    while n > 127:
        out.append(n & 127 | 128)
        n >>= 7
    return bytes([*out, n])


def without_prefix(model: bytes) -> tuple[bytes, dict]:
    """The model with no space put before texts, and what its normalizer and trainer say."""
    out, facts = [], {"name": b"", "prefix": 1, "squeeze": 1, "kind": 1}
    for number, _, value, raw in _fields(model):
        if number == 2:
            facts["kind"] = next((v for n, _, v, _ in _fields(value) if n == 3), 1)
        if number == 3:
            kept = []
            for n, _, v, r in _fields(value):
                facts |= {1: {"name": v}, 3: {"prefix": v}, 4: {"squeeze": v}}.get(n, {})
                kept += [r] if n != 3 else []
            body = b"".join(kept) + b"\x18\x00"
            raw = b"\x1a" + _encoded_size(len(body)) + body
        out.append(raw)
    return b"".join(out), facts


class _Units:
    """The ids of units, bytes that begin with a space, in one array; those of the units met before are remembered."""

    def __init__(self, model):
        self.model = model
        self._reset()

    def _reset(self) -> None:
        self.memo: dict[bytes, int] = {}
        self.ids, self.begins, self.sizes = np.zeros(0, np.int32), np.zeros(0, np.int64), np.zeros(0, np.int64)

    def places(self, units: list[bytes]) -> np.ndarray:
        """Where begins and sizes of each unit stand."""
        if len(self.memo) > MEMO or len(self.ids) > MEMO_IDS:
            self._reset()
        found = list(map(self.memo.get, units))
        unseen = [i for i, x in enumerate(found) if x is None]
        if unseen:
            new = self.model.encode([units[i].decode("utf-8", "surrogatepass") for i in unseen], num_threads=1)
            sizes = np.fromiter(map(len, new), np.int64, len(new))
            first, end = len(self.begins), len(self.ids)
            self.begins = np.append(self.begins, end + np.cumsum(sizes) - sizes)
            self.sizes = np.append(self.sizes, sizes)
            self.ids = np.append(self.ids, np.fromiter(chain.from_iterable(new), np.int32, int(sizes.sum())))
            for at, i in enumerate(unseen, first):
                found[i] = at
                if len(units[i]) <= MEMO_LENGTH:
                    self.memo[units[i]] = at
        return np.array(found, np.int64)

    def encode(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids, where those of each text begin and end) of texts that lie side by side, spaces for space marks."""
        if not len(data):
            return np.zeros(0, np.int32), np.zeros(len(offsets), np.int64)
        space = data == 32
        start = space.copy()
        start[1:] &= ~space[:-1]
        begins = offsets[:-1][offsets[:-1] < offsets[1:]]
        start[begins] = True
        at = np.append(np.flatnonzero(start), len(data))
        units = pa.Array.from_buffers(pa.binary(), len(at) - 1, [None, pa.py_buffer(at.astype(np.int32)), pa.py_buffer(data)]).dictionary_encode()
        place = self.places(units.dictionary.to_pylist())[units.indices.to_numpy()]
        sizes = self.sizes[place]
        upto = np.append(0, np.cumsum(sizes))
        ids = self.ids[np.repeat(self.begins[place] - upto[:-1], sizes) + np.arange(upto[-1])]
        return ids, upto[np.searchsorted(at, offsets)]


class Codec:
    """A model's encoding by units, its decoding, and what the scan needs of it."""

    def __init__(self, path: str):
        import sentencepiece

        with open(path, "rb") as f:
            model = f.read()
        self.whole = sentencepiece.SentencePieceProcessor(model_proto=model)
        bare, facts = without_prefix(model)
        self.prefix = bool(facts["prefix"])
        n = self.whole.vocab_size()
        names = [self.whole.id_to_piece(i) for i in range(n)]
        usual = [not (self.whole.is_byte(i) or self.whole.is_control(i) or self.whole.is_unknown(i) or self.whole.is_unused(i)) for i in range(n)]
        self.pieces = {p: i for i, (p, own) in enumerate(zip(names, usual)) if own}
        self.longest = max(map(len, self.pieces), default=1)
        #: Texts can be encoded unit by unit.
        self.splits = facts["kind"] == 2 and facts["name"] == b"identity" and not facts["squeeze"] and not any(MARK in p.lstrip(MARK) for p in self.pieces)
        self.bare = sentencepiece.SentencePieceProcessor(model_proto=bare) if self.splits else self.whole
        self.unigram = facts["kind"] == 1
        #: The scan applies.
        self.scans = self.splits or self.unigram
        self.scores = {p: self.whole.get_score(i) for p, i in self.pieces.items()} if self.unigram else {}
        self.unknown = min(self.scores.values(), default=0.0) - 10  # a character that no piece covers
        spelled = [bytes([int(p[3:5], 16)]) if self.whole.is_byte(i) else b"" if self.whole.is_control(i) else self.whole.decode([i]).encode() if self.whole.is_unknown(i) else p.replace(MARK, " ").encode() for i, p in enumerate(names)]
        self.bytes = pa.array(spelled, pa.binary())
        self.units = _Units(self.bare)
        self.body: tuple = ()
        self.pairs: dict[tuple[str, str], bool] = {}

    def marked(self, text: str) -> str:
        """As the normalizer leaves it."""
        if self.unigram:
            return self.whole.normalize(text)
        text = text.replace(" ", MARK)
        return MARK + text if self.prefix and text else text

    def encode_marked(self, marked: str) -> list[int]:
        data = np.frombuffer(marked.replace(MARK, " ").encode("utf-8", "surrogatepass"), np.uint8)
        return self.units.encode(data, np.array([0, len(data)]))[0].tolist()

    def encode(self, texts: pa.Array) -> pa.ListArray:
        """Lists of ids of texts; null for null."""
        texts = texts.cast(pa.string())
        if self.splits:
            plain = pc.replace_substring(pc.fill_null(texts, ""), MARK, " ")
            if self.prefix:
                plain = pc.if_else(pc.equal(pc.binary_length(plain), 0), "", pc.binary_join_element_wise(" ", plain, ""))
            own = np.frombuffer(plain.buffers()[1], np.int32)[plain.offset : plain.offset + len(plain) + 1].astype(np.int64)
            data = np.frombuffer(plain.buffers()[2] or b"", np.uint8)[own[0] : own[-1]]
            ids, at = self.units.encode(data, own - own[0])
        else:
            found = self.whole.encode(texts.fill_null("").to_pylist(), num_threads=1)
            at = np.cumsum([0, *map(len, found)])
            ids = np.fromiter(chain.from_iterable(found), np.int32, int(at[-1]))
        null = texts.is_null().to_numpy(zero_copy_only=False)
        return pa.ListArray.from_arrays(pa.array(at.astype(np.int32), mask=np.append(null, False)), pa.array(ids, pa.int32()))

    def decode(self, lists: pa.ListArray) -> pa.Array:
        """The texts that lists of ids stand for; null for null."""
        own = lists.offsets.to_numpy().astype(np.int64)
        spelled = self.bytes.take(lists.values.slice(own[0], own[-1] - own[0]))
        ends = np.frombuffer(spelled.buffers()[1], np.int32)[spelled.offset : spelled.offset + len(spelled) + 1] if len(spelled) else np.zeros(1, np.int32)
        raw = pa.Array.from_buffers(pa.binary(), len(lists), [None, pa.py_buffer(np.ascontiguousarray(ends[own - own[0]])), spelled.buffers()[2] if len(spelled) else pa.py_buffer(b"")])
        try:
            texts = raw.cast(pa.string())  # checks that it is valid
        except pa.ArrowInvalid:
            texts = pa.array([x.decode("utf-8", "replace") for x in raw.to_pylist()], pa.string())
        if self.prefix:
            texts = pc.if_else(pc.starts_with(texts, " "), pc.utf8_slice_codeunits(texts, 1), texts)
        return pc.if_else(lists.is_valid(), texts, None)

    # The scan.

    def apart(self, left: str, right: str) -> bool:
        """The model leaves these neighbouring tokens as they are."""
        if (left, right) not in self.pairs:
            if len(self.pairs) > MEMO:
                self.pairs.clear()
            self.pairs[left, right] = self.bare.encode(left + right) == self._token(left) + self._token(right)
        return self.pairs[left, right]

    def _token(self, string: str) -> list[int]:
        if string in self.pieces:
            return [self.pieces[string]]
        if not self.unigram:
            return self.bare.encode(string)
        unknown = self.whole.unk_id()
        of_bytes = [self.whole.piece_to_id(f"<0x{x:02X}>") for x in string.encode()]
        return of_bytes if all(map(self.whole.is_byte, of_bytes)) else [unknown]

    def states(self, text: str, at: int) -> list[tuple[int, int]]:
        """The tokens that may cover the character before `at`, as (begin, end); text: marked."""
        found = [(at - 1, at)]  # a character, whether a piece or bytes
        for begin in range(max(0, at - self.longest), at):
            for end in range(at, min(len(text), begin + self.longest) + 1):
                if (begin, end) != (at - 1, at) and text[begin:end] in self.pieces:
                    found.append((begin, end))
        return found

    def _spelled(self, ids: list[int], text: str, first: bool) -> str:
        """The first or last token of the ids of `text` as a string; bytes stand for their character."""
        i = ids[0 if first else -1]
        if self.whole.is_byte(i):
            return text[0] if first else text[-1]
        return self.whole.id_to_piece(i)

    def _span(self, text: str, a: int, b: int, near: int) -> list[int]:
        """The ids of text[a:b]; up to the last unit that begins before `near` they are remembered for the next call."""
        at = text.rfind(MARK, a + 1, max(a + 1, min(near, b)))
        while at > a and text[at - 1] == MARK:
            at -= 1
        if at <= a:
            return self.encode_marked(text[a:b])
        if self.body[:1] != ((text, a, at),):
            self.body = ((text, a, at), self.encode_marked(text[a:at]))
        return self.body[1] + self.encode_marked(text[at:b])

    # A unigram model's scores.

    def score(self, text: str, state: tuple[int, int]) -> float:
        return self.scores.get(text[state[0] : state[1]], self.unknown)

    def best(self, text: str, starts: list[int], stop: int) -> np.ndarray:
        """[place, start]: the score of the best path from each of `starts` to each place from the first of them up to `stop`."""
        base = min(starts)
        out = np.full((stop - base + 1, len(starts)), -np.inf)
        out[np.array(starts) - base, np.arange(len(starts))] = 0.0
        for i in range(base, stop):
            for j, score in self._steps(text, i, stop):
                np.maximum(out[j - base], out[i - base] + score, out=out[j - base])
        return out

    def _steps(self, text: str, i: int, stop: int) -> list[tuple[int, float]]:
        """(end, score) of the tokens that begin at i."""
        found = [(j, self.scores[text[i:j]]) for j in range(i + 1, min(stop, i + self.longest) + 1) if text[i:j] in self.scores]
        return found if found and found[0][0] == i + 1 else [(i + 1, self.unknown), *found]

    def _traced(self, text: str, a: int, b: int) -> list[int]:
        """The ids of the best path through text[a:b]."""
        score, via = [0.0, *[-np.inf] * (b - a)], [a] * (b - a + 1)
        for i in range(a, b):
            for j, own in self._steps(text, i, b):
                if score[i - a] + own > score[j - a]:
                    score[j - a], via[j - a] = score[i - a] + own, i
        out, at = [], b
        while at > a:
            out.append(self._token(text[via[at - a] : at]))
            at = via[at - a]
        return list(chain.from_iterable(reversed(out)))

    def path(self, text: str, start: tuple[int, int] | None, end: tuple[int, int] | None, near: int = 0) -> list[int] | None:
        """The ids behind state `start` up to and with state `end`, or None if no path is allowed.

        None as a state: the text's begin or end. near: a place before all states of the end.
        """
        a = start[1] if start else 0
        b = end[0] if end else len(text)
        if start and end and start == end:
            return []
        if a > b:
            return None
        if self.unigram:
            return self._traced(text, a, b) + (self._token(text[end[0] : end[1]]) if end else [])
        ids = self._span(text, a, b, near) if b > a else []
        left = text[start[0] : start[1]] if start else None
        right = text[end[0] : end[1]] if end else None
        if not ids:
            if left is not None and right is not None and not self.apart(left, right):
                return None
        else:
            if left is not None and not self.apart(left, self._spelled(ids, text[a:b], True)):
                return None
            if right is not None and not self.apart(self._spelled(ids, text[a:b], False), right):
                return None
        return ids + (self._token(right) if right is not None else [])


_codecs: dict[str, Codec] = {}


def codec(path: str) -> Codec:
    if path not in _codecs:
        _codecs[path] = Codec(path)
    return _codecs[path]


def max_plus(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The product of two transfer matrices."""
    return (a[:, :, None] + b[None, :, :]).max(axis=1)


def boundaries(marked: str, chunk: int, snap: int = SNAP) -> list[int]:
    """Where the chunks of a marked text begin, and its end; at ends of words where one is near."""
    out, n = [0], len(marked)
    while n - out[-1] > 2 * chunk:
        at = out[-1] + chunk
        m = _NEXT.search(marked, at, min(n, at + snap))
        out.append(m.start() if m else at)
    return [*out, n]


def transfer(own: Codec, text: str, begin: int, end: int, n: int) -> tuple[list, list, np.ndarray]:
    """(states at the begin, states at the end, matrix) of a chunk of `text`, a part of a marked text of which it
    holds all that states can reach. begin, end: in `text`; n: 0 for the first chunk, -1 for the last, else 1."""
    starts = [None] if n == 0 else own.states(text, begin)
    ends = [None] if n == -1 else own.states(text, end)
    if own.unigram:
        a, b = [s[1] if s else 0 for s in starts], [e[0] if e else len(text) for e in ends]
        best = own.best(text, a, max(b))
        last = np.array([own.score(text, e) if e else 0.0 for e in ends])
        return starts, ends, best[np.array(b) - min(a)].T + last
    matrix = np.array([[0.0 if own.path(text, s, e, end - own.longest) is not None else -np.inf for e in ends] for s in starts])
    return starts, ends, matrix


def scan(matrices: list[np.ndarray], first: int, last: int) -> list[int]:
    """The state at each boundary, from state `first` before to state `last` behind the matrices."""
    ahead = [np.where(np.arange(matrices[0].shape[0]) == first, 0.0, -np.inf)]
    for m in matrices:
        ahead.append((ahead[-1][:, None] + m).max(axis=0))
    out = [last]
    for m, reach in zip(reversed(matrices), reversed(ahead[:-1])):
        out.append(int(np.argmax(reach + m[:, out[-1]])))
    return out[::-1]


_CHUNK = pa.schema([("key", pa.string()), ("no", pa.int32()), ("last", pa.bool_()), ("begin", pa.int32()), ("finish", pa.int32()), ("part", pa.string())])
_MATRIX = pa.schema([("key", pa.string()), ("no", pa.int32()), ("block", pa.int32()), ("n_in", pa.int32()), ("n_out", pa.int32()), ("scores", pa.binary())])
_ENDS = pa.schema([("key", pa.string()), ("no", pa.int32()), ("first", pa.int32()), ("last", pa.int32())])
_IDS = pa.schema([("key", pa.string()), ("no", pa.int32()), ("ids", pa.list_(pa.int32()))])


def _ddl(schema: pa.Schema) -> str:
    kinds = {"bool": "boolean", "int32": "int", "list<item: int32>": "array<int>", "list<element: int32>": "array<int>"}
    return ", ".join(f"{f.name} {kinds.get(str(f.type), str(f.type))}" for f in schema)


def _unpacked(row: dict) -> np.ndarray:
    return np.frombuffer(row["scores"], np.float64).reshape(row["n_in"], row["n_out"])


def _rows(of: pa.RecordBatch | pa.Table) -> list[dict]:
    return of.to_pylist()


def _encode_giants(texts: DataFrame, path: str, chunk: int, block: int) -> DataFrame:
    """texts: key and text, keys distinct. Returns (key, ids)."""

    def cut(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(path)
        for batch in batches:
            for key, text in zip(*batch.columns):
                marked = own.marked(text.as_py() if own.unigram else text.as_py().replace(MARK, " "))
                at = boundaries(marked, chunk)
                rows = []
                for no, (a, b) in enumerate(zip(at, at[1:])):
                    low, high = max(0, a - own.longest), min(len(marked), b + own.longest)
                    rows.append({"key": key.as_py(), "no": no, "last": b == len(marked), "begin": a - low, "finish": b - low, "part": marked[low:high]})
                yield from pa.Table.from_pylist(rows, _CHUNK).to_batches(64)

    def kind(row: dict) -> int:
        return -1 if row["last"] else min(row["no"], 1)

    def matrices(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(path)
        for batch in batches:
            rows = []
            for r in _rows(batch):
                starts, ends, m = transfer(own, r["part"], r["begin"], r["finish"], kind(r))
                rows.append({"key": r["key"], "no": r["no"], "block": r["no"] // block, "n_in": len(starts), "n_out": len(ends), "scores": np.ascontiguousarray(m).tobytes()})
            yield pa.RecordBatch.from_pylist(rows, _MATRIX)

    def folded(table: pa.Table) -> pa.Table:
        """A block's matrices, `block` at most, as one."""
        rows = _rows(table.sort_by("no"))
        m = _unpacked(rows[0])
        for r in rows[1:]:
            m = max_plus(m, _unpacked(r))
        return pa.Table.from_pylist([{"key": rows[0]["key"], "no": rows[0]["block"], "block": rows[0]["block"], "n_in": m.shape[0], "n_out": m.shape[1], "scores": m.tobytes()}], _MATRIX)

    def traced(table: pa.Table) -> pa.Table:
        """(key, no, state before, state behind) of the matrices of a group. `first` and `last` hold the group's own ends."""
        rows = _rows(table.sort_by("no"))
        states = scan([_unpacked(r) for r in rows], rows[0]["first"], rows[0]["last"])
        return pa.Table.from_pylist([{"key": r["key"], "no": r["no"], "first": a, "last": b} for r, a, b in zip(rows, states, states[1:])], _ENDS)

    def emitted(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(path)
        for batch in batches:
            rows = []
            for r in _rows(batch):
                n = kind(r)
                start = None if n == 0 else own.states(r["part"], r["begin"])[r["before"]]
                end = None if n == -1 else own.states(r["part"], r["finish"])[r["behind"]]
                rows.append({"key": r["key"], "no": r["no"], "ids": own.path(r["part"], start, end)})
            yield pa.RecordBatch.from_pylist(rows, _IDS)

    cut_up = texts.mapInArrow(cut, _ddl(_CHUNK)).repartition(F.col("key"), F.col("no"))  # a document's chunks go to many tasks
    cut_up = cut_lineage(cut_up)
    each = cut_lineage(cut_up.mapInArrow(matrices, _ddl(_MATRIX)))
    blocks = each.groupBy("key", "block").applyInArrow(folded, _ddl(_MATRIX))
    whole = blocks.withColumns({"first": F.lit(0), "last": F.lit(0)}).groupBy("key").applyInArrow(traced, _ddl(_ENDS))
    inner = each.join(whole.withColumnRenamed("no", "block"), ["key", "block"]).groupBy("key", "block").applyInArrow(traced, _ddl(_ENDS))
    inner = inner.select("key", "no", F.col("first").alias("before"), F.col("last").alias("behind"))
    ids = cut_up.join(inner, ["key", "no"]).mapInArrow(emitted, _ddl(_IDS))
    ordered = F.sort_array(F.collect_list(F.struct("no", "ids")))  # a document's own row
    out = ids.groupBy("key").agg(F.flatten(F.transform(ordered, lambda x: x["ids"])).alias("ids"))
    own = codec(path)
    if own.unigram:  # the library gives one id for neighbouring unknown characters
        unknown = own.whole.unk_id()
        out = out.withColumn("ids", F.filter("ids", lambda x, i: (x != unknown) | (i == 0) | (F.get("ids", i - 1) != unknown)))
    return out


def _model(path: str | None, vocabulary: str) -> str:
    if path:
        return path
    import public_tokenizers

    return public_tokenizers.path(vocabulary)


def encode(docs: DataFrame, vocabulary: str = "piece_bpe_32k.model", path: str | None = None, text: str = "text", giant: int = GIANT, chunk: int = CHUNK, block: int = BLOCK) -> DataFrame:
    """`docs` with `ids`, the library's ids of the whole text."""
    path = _model(path, vocabulary)
    own = [c for c in docs.columns if c != "ids"]
    docs = docs.select(*own)
    schema = T.StructType([*(T.StructField(f.name, f.dataType) for f in docs.schema), T.StructField("ids", T.ArrayType(T.IntegerType()))])
    at = own.index(text)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = codec(path)
        for batch in batches:
            for i in range(0, len(batch), ROWS):
                rows = batch.slice(i, ROWS)
                yield pa.RecordBatch.from_arrays([*rows.columns, known.encode(rows.column(at))], names=schema.names)
        pa.default_memory_pool().release_unused()

    if not codec(path).scans:
        return docs.mapInArrow(run, schema)
    small = docs.where(F.coalesce(F.length(text) <= giant, F.lit(True)))
    (key,) = fresh(own, "key")
    large = cut_lineage(docs.where(F.length(text) > giant).withColumn(key, F.sha2(F.col(text), 256)))
    texts = large.groupBy(F.col(key).alias("key")).agg(F.first(text).alias("text"))
    ids = _encode_giants(texts, path, chunk, block).toDF(key, "ids")
    return small.mapInArrow(run, schema).union(large.join(ids, key).select(*own, "ids"))


def decode(docs: DataFrame, vocabulary: str = "piece_bpe_32k.model", path: str | None = None, ids: str = "ids", name: str = "decoded") -> DataFrame:
    """`docs` with the text that `ids` stand for."""
    path = _model(path, vocabulary)
    own = [c for c in docs.columns if c != name]
    docs = docs.select(*own)
    schema = T.StructType([*(T.StructField(f.name, f.dataType) for f in docs.schema), T.StructField(name, T.StringType())])
    at = own.index(ids)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = codec(path)
        for batch in batches:
            yield pa.RecordBatch.from_arrays([*batch.columns, known.decode(batch.column(at))], names=schema.names)
        pa.default_memory_pool().release_unused()

    return docs.mapInArrow(run, schema)


def op8_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    out = decode(encode(docs))
    return out.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), F.xxhash64("ids").alias("ids_digest"), "ids", (F.col("decoded") == F.translate("text", MARK, " ")).alias("round_trip"))
