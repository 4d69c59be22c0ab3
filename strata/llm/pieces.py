"""SentencePiece (BPE) encoding and decoding that keeps source offsets.

A text is normalised as its model file prescribes: at each place the longest prefix that the compiled
character map holds is replaced (a double-array trie over bytes, walked byte by byte), any other character
stands for itself, spaces become U+2581 and one is put before the text. For every normalised byte, and for the
end, the place in the source at which its prefix began is recorded; a piece that covers normalised bytes
[b, e) covers source bytes [align[b], align[e]). Characters outside the vocabulary become byte pieces, of which
the last one holds the character's span and the others are empty at its start.

Pieces are merged by score, leftmost first among equal scores. No vocabulary piece joins a pair of characters
that stands next to each other in none; a normalised text is cut at such pairs into chunks that merge
independently. A task merges each distinct chunk once (short ones side by side in numpy, one merge of each at a
time) and keeps its ids, piece ends and decoded text; a document's ids and spans are then gathered in numpy.

Work is per document and per distinct chunk of a task, so nothing is shuffled. The model's file is read on the
driver, where its path is a parameter, and broadcast as bytes (0.5 MB here); tasks parse it.

Cases: NULL and empty texts have no pieces and decode to an empty text; U+2581 in a text decodes to a space;
control symbols (``<s>``) and byte names (``<0x41>``) that a text spells out are plain text; rows with equal ids
are documents of their own; an id is carried as it is. Models that are not BPE, that define user symbols or
that put the space behind words are refused by name.
"""

from __future__ import annotations

import re
import struct
from collections.abc import Iterator
from heapq import heapify, heappop, heappush

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from .exchange import named
from .text import slices, text_buffers

#: Distinct chunks that a task keeps encoded; then it starts anew, which bounds its memory.
KEPT_CHUNKS = 300_000
#: Text whose new chunks are merged side by side.
SLICE_BYTES = 2 << 20
#: Characters of chunks that are merged side by side, as groups of at most so many; longer ones are merged alone.
SIDE_BY_SIDE = (3, 5, 7, 9, 12, 16, 24)
#: Symbols beyond which a chunk is merged by a heap.
LONG_CHUNK = 64
#: The space symbol, and the numbers of piece types in the model format.
SPACE = "▁"
_NEVER = 1 << 30
_NORMAL, _UNKNOWN, _CONTROL, _USER, _UNUSED, _BYTE = 1, 2, 3, 4, 5, 6


def fields(blob: bytes) -> Iterator[tuple[int, int | bytes]]:
    """(number, value) of each field of a protocol buffer message; nested messages are bytes."""
    at, n = 0, len(blob)

    def varint():
        nonlocal at
        out = shift = 0
        while True:
            b = blob[at]
            at += 1
            out |= (b & 127) << shift
            shift += 7
            if b < 128:
                return out

    while at < n:
        key = varint()
        kind = key & 7
        if kind == 0:
            yield key >> 3, varint()
        else:
            size = varint() if kind == 2 else {1: 8, 5: 4}[kind]
            yield key >> 3, blob[at : at + size]
            at += size


class CharacterMap:
    """The compiled character map: replacements by longest prefix, with source alignment."""

    def __init__(self, blob: bytes):
        size = struct.unpack_from("<I", blob)[0] if blob else 0
        self.units = np.frombuffer(blob, "<u4", size // 4, 4).tolist() if size else []
        self.values = blob[4 + size :] if size else b""
        root = self._offset(self.units[0]) if self.units else 0
        starts = bytes(b for b in range(1, 256) if self.units and self.units[root ^ b] & 0x800000FF == b)
        self.starts = starts

    @staticmethod
    def _offset(unit: int) -> int:
        return (unit >> 10) << ((unit & 0x200) >> 6)

    def longest(self, text: bytes, at: int) -> tuple[int, bytes] | None:
        """Length of the longest key that the text has there, and what replaces it."""
        units, found = self.units, None
        node = self._offset(units[0])
        for k in range(at, len(text)):
            node ^= text[k]
            unit = units[node]
            if unit & 0x800000FF != text[k]:
                break
            node ^= self._offset(unit)
            if unit & 0x100:
                found = k + 1 - at, units[node] & 0x7FFFFFFF
        if found is None:
            return None
        return found[0], self.values[found[1] : self.values.index(0, found[1])]


class Normalizer:
    """Text to normalised bytes, and for each of them and the end a place in the source."""

    def __init__(self, charsmap: bytes = b"", dummy_prefix: bool = True, extra_spaces_go: bool = True, escape: bool = True):
        self.map = CharacterMap(charsmap)
        self.dummy_prefix, self.extra_spaces_go = dummy_prefix, extra_spaces_go
        self.space = SPACE.encode() if escape else b" "
        #: Bytes at which more happens than that a character stands for itself.
        self.stops = re.compile(b"[" + re.escape(self.map.starts + b" ") + b"]")
        self.plain = not self.map.units and not extra_spaces_go

    def __call__(self, text: bytes) -> tuple[bytes, np.ndarray]:
        if not text:
            return b"", np.zeros(1, np.int32)
        if not self.plain:
            return self._by_prefix(text)
        lead = self.space if self.dummy_prefix else b""
        width = np.where(np.frombuffer(text, np.uint8) == 32, len(self.space), 1)
        align = np.repeat(np.arange(len(text), dtype=np.int32), width)
        return lead + text.replace(b" ", self.space), np.concatenate([np.zeros(len(lead), np.int32), align, [np.int32(len(text))]])

    def _prefixes(self, text: bytes):
        """(from, to, replacement) of the source; None stands for itself, without a space in it."""
        at, n = 0, len(text)
        while at < n:
            stop = self.stops.search(text, at)
            to = stop.start() if stop else n
            if to > at:
                yield at, to, None
            if stop:
                found = self.map.longest(text, to) if self.map.units else None
                if found:
                    at = to + found[0]
                    yield to, at, found[1]
                else:  # one character
                    at = to + 1
                    while at < n and text[at] & 0xC0 == 0x80:
                        at += 1
                    yield to, at, text[to:at]
            else:
                at = n

    def _by_prefix(self, text: bytes) -> tuple[bytes, np.ndarray]:
        out, align = bytearray(), []
        before_space, begun, seen = self.extra_spaces_go, False, 0
        for a, b, new in self._prefixes(text):
            if not begun:
                if new == b" " and self.extra_spaces_go:
                    seen = b
                    continue
                begun = True
                if self.dummy_prefix:
                    out += self.space
                    align += [a] * len(self.space)
            seen = b
            if new is None:
                out += text[a:b]
                align += range(a, b)
                before_space = False
                continue
            if before_space:
                new = new.lstrip(b" ")
            if new:
                shown = new.replace(b" ", self.space)
                out += shown
                align += [a] * len(shown)
                before_space = new.endswith(b" ")
            if not self.extra_spaces_go:
                before_space = False
        if not begun:
            return b"", np.zeros(1, np.int32)
        if self.extra_spaces_go:
            while out.endswith(self.space):
                seen = align[len(out) - len(self.space)]
                del out[-len(self.space) :]
        return bytes(out), np.array([*align[: len(out)], seen], np.int32)


class PieceModel:
    """Vocabulary, scores and normaliser of one model file."""

    def __init__(self, blob: bytes):
        pieces, trainer, normal = [], {}, {}
        for number, value in fields(blob):
            if number == 1:
                own = {1: b"", 2: b"\0\0\0\0", 3: _NORMAL} | dict(fields(value))
                pieces.append((own[1].decode(), struct.unpack("<f", own[2])[0], own[3]))
            elif number == 2:
                trainer = dict(fields(value))
            elif number == 3:
                normal = dict(fields(value))
        if trainer.get(3, 1) != 2:
            raise ValueError("only BPE models are encoded")
        if trainer.get(24, 0):
            raise ValueError("models that put the space behind words are not encoded")
        if any(kind == _USER for _, _, kind in pieces):
            raise ValueError("models with user-defined symbols are not encoded")
        self.pieces = pieces
        self.normalizer = Normalizer(normal.get(2, b""), bool(normal.get(3, 1)), bool(normal.get(4, 1)), bool(normal.get(5, 1)))
        self.no_lead = bool(normal.get(3, 1)) or bool(normal.get(4, 1))
        self.drop_all_lead = bool(normal.get(4, 1))
        self.unknown = next(i for i, p in enumerate(pieces) if p[2] == _UNKNOWN)
        self.unknown_shown = trainer.get(44, " ⁇ ".encode()).decode()
        self.bytes = {int(p[1:-1], 16): i for i, (p, _, kind) in enumerate(pieces) if kind == _BYTE} if trainer.get(35, 0) else {}
        self.byte_of = {i: b for b, i in self.bytes.items()}
        self.reserved = {p: i for i, (p, _, kind) in enumerate(pieces) if kind in (_UNKNOWN, _CONTROL, _BYTE)}
        self.known = {p: i for i, (p, _, kind) in enumerate(pieces) if kind in (_NORMAL, _UNUSED)}
        order = {s: -k for k, s in enumerate(sorted({pieces[i][1] for i in self.known.values()}))}
        #: Place of a piece in the order of merging: highest score first, equal scores at one place.
        self.place = {p: order[pieces[i][1]] for p, i in self.known.items()}
        self.unused = {p for p, i in self.known.items() if pieces[i][2] == _UNUSED}
        self.joint = {a + b for p in self.known for a, b in zip(p, p[1:], strict=False)}
        self.cut = self._chunk_pattern()
        self._number_pairs()

    def _chunk_pattern(self) -> re.Pattern | None:
        """How a normalised text falls into chunks with no merge across; the finest of three that the vocabulary allows."""
        if any(b == SPACE != a for a, b in self.joint):
            return None
        first = "".join(map(chr, [*range(0x21, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x7F)]))  # ASCII but letters
        across = sorted(p for p in self.joint if p[1] in first and p[0] not in first + SPACE)
        if any("\n" in pair for pair in self.joint) or len(across) > 100:
            return re.compile(f"{SPACE}+[^{SPACE}]*|[^{SPACE}]+")
        first = re.escape(first)
        rest = f"[^{first}{SPACE}\n]"
        on = "".join(f"|(?<={re.escape(a)}){re.escape(b)}[{first}]*{rest}*" for a, b in across)
        on = f"(?:{on[1:]})*" if on else ""
        return re.compile(f"{SPACE}+[{first}]*{rest}*{on}|[{first}]+{rest}*{on}|{rest}+{on}|\n")

    def _number_pairs(self) -> None:
        """Pairs of pieces that make a piece, as sorted numbers; only pieces are parts here, see ``merge_many``."""
        pairs = {}
        for p, i in self.known.items():
            for k in range(1, len(p)):
                a, b = self.known.get(p[:k]), self.known.get(p[k:])
                if a is not None and b is not None:
                    pairs[a * len(self.pieces) + b] = i
        self.pair = np.array([*sorted(pairs), 1 << 62], np.int64)
        self.pair_makes = np.array([*(pairs[k] for k in sorted(pairs)), 0], np.int32)
        place = [self.place.get(self.pieces[i][0], _NEVER) for i in self.pair_makes.tolist()]
        self.pair_place = np.array(place, np.int32)
        self.of_char = np.full(0x110000, -1, np.int32)
        for p, i in self.known.items():
            if len(p) == 1:
                self.of_char[ord(p)] = i
        parts = {c for p in self.known for c in p}
        #: Characters that are in pieces but are none; chunks with them are merged one by one.
        self.of_char[[ord(c) for c in parts if c not in self.known]] = -2
        self.n_bytes = np.array([len(p.encode()) for p, _, _ in self.pieces], np.int32)

    def _places(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Of each pair of pieces: the place in the order of merging, and what it makes."""
        key = left.astype(np.int64) * len(self.pieces) + right
        at = np.searchsorted(self.pair, key)
        hit = (self.pair[at] == key) & (left >= 0) & (right >= 0)
        return np.where(hit, self.pair_place[at], _NEVER), self.pair_makes[at]

    def merge_many(self, ids: np.ndarray) -> np.ndarray:
        """Chunks as columns of piece numbers of single characters, filled up with -1: merged, filled up with -1."""
        n = ids.shape[1]
        out = ids.copy()
        place, makes = self._places(ids[:-1], ids[1:])
        column = np.arange(n)
        row = np.arange(len(ids))[:, None]
        while len(column):
            at = place.argmin(axis=0)
            own = np.arange(len(column))
            on = place[at, own] < _NEVER
            out[: len(ids), column[~on]] = ids[:, ~on]
            ids, place, makes, column, at = ids[:, on], place[:, on], makes[:, on], column[on], at[on]
            if not len(column):
                break
            own = np.arange(len(column))
            ids[at, own] = makes[at, own]
            behind = np.minimum(row + (row > at), len(ids) - 1)
            ids = np.take_along_axis(ids, behind, axis=0)
            ids[-1] = -1
            pairs = row[: len(ids) - 1]
            behind = np.minimum(pairs + (pairs > at), len(pairs) - 1)
            place, makes = np.take_along_axis(place, behind, axis=0), np.take_along_axis(makes, behind, axis=0)
            place[-1] = _NEVER
            for side in (at - 1, at):  # the pairs of the new piece with its neighbours
                ok = (side >= 0) & (side < len(pairs))
                s, o = side[ok], own[ok]
                place[s, o], makes[s, o] = self._places(ids[s, o], ids[s + 1, o])
        return out

    def merge(self, symbols: list[str]) -> list[str]:
        """Characters merged by score, leftmost first among equals."""
        if len(symbols) > LONG_CHUNK:
            return self._merge_by_heap(symbols)
        place, none = self.place, 1 << 60
        made = {}
        ranks = [place.get(a + b, none) for a, b in zip(symbols, symbols[1:], strict=False)]
        while ranks:
            least = min(ranks)
            if least == none:
                break
            i = ranks.index(least)
            new = symbols[i] + symbols[i + 1]
            if new in self.unused:
                made[new] = symbols[i], symbols[i + 1]
            symbols[i : i + 2] = [new]
            del ranks[i]
            if i:
                ranks[i - 1] = place.get(symbols[i - 1] + new, none)
            if i < len(ranks):
                ranks[i] = place.get(new + symbols[i + 1], none)
        return self._parted(symbols, made) if made else symbols

    def _merge_by_heap(self, symbols: list[str]) -> list[str]:
        place, none, n = self.place, 1 << 60, len(symbols)
        made: dict[str, tuple[str, str]] = {}
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        ready = [(r, i, a + b) for i, (a, b) in enumerate(zip(symbols, symbols[1:], strict=False)) if (r := place.get(a + b, none)) < none]
        heapify(ready)
        while ready:
            _, i, new = heappop(ready)
            j = after[i]
            if not symbols[i] or j >= n or symbols[i] + symbols[j] != new:
                continue
            if new in self.unused:
                made[new] = symbols[i], symbols[j]
            symbols[i], symbols[j] = new, ""
            after[i] = after[j]
            if after[i] < n:
                before[after[i]] = i
                joined = new + symbols[after[i]]
                if (r := place.get(joined, none)) < none:
                    heappush(ready, (r, i, joined))
            if before[i] >= 0:
                joined = symbols[before[i]] + new
                if (r := place.get(joined, none)) < none:
                    heappush(ready, (r, before[i], joined))
        symbols = [s for s in symbols if s]
        return self._parted(symbols, made) if made else symbols

    def _parted(self, symbols: list[str], made: dict[str, tuple[str, str]]) -> list[str]:
        """Unused pieces fall back into the two that made them."""
        out, todo = [], symbols[::-1]
        while todo:
            s = todo.pop()
            if s in self.unused and s in made:
                todo += made[s][::-1]
            else:
                out.append(s)
        return out

    def encode_chunk(self, chunk: str) -> tuple[list[int], list[int], list[int]]:
        """Ids, and each piece's first and last normalised byte (end exclusive) within the chunk."""
        ids, begins, ends = [], [], []
        at = 0
        for s in self.merge(list(chunk)):
            token = self.reserved.get(s)
            if token is None:
                token = self.known.get(s, self.unknown)
            raw = s.encode()
            size = len(raw)
            if token == self.unknown and self.bytes:
                ids += [self.bytes[b] for b in raw]
                begins += [at] * size
                ends += [*[at] * (size - 1), at + size]
            elif token == self.unknown and ids and ids[-1] == token:
                ends[-1] = at + size
            else:
                ids.append(token)
                begins.append(at)
                ends.append(at + size)
            at += size
        return ids, begins, ends

    def shown(self, ids: list[int]) -> str:
        """The text of some pieces; U+2581 is not yet a space, so that the first one can be told."""
        out, raw = [], bytearray()
        for i in ids:
            b = self.byte_of.get(i)
            if b is not None:
                raw.append(b)
                continue
            if raw:
                out.append(_utf8(raw))
                raw = bytearray()
            piece, _, kind = self.pieces[i]
            out.append("" if kind == _CONTROL else self.unknown_shown if kind == _UNKNOWN else piece)
        if raw:
            out.append(_utf8(raw))
        return "".join(out)

    def whole(self, shown: str) -> str:
        """The decoded text of all pieces as shown one after the other."""
        if self.drop_all_lead:
            shown = shown.lstrip(SPACE)
        elif self.no_lead and shown.startswith(SPACE):
            shown = shown[1:]
        return shown.replace(SPACE, " ")

    def decode(self, ids: list[int]) -> str:
        return self.whole(self.shown(ids))


def _utf8(raw: bytearray) -> str:
    """Bytes as text; each byte of what is no character is U+FFFD."""
    out, at = [], 0
    while at < len(raw):
        try:
            out.append(raw[at:].decode())
            break
        except UnicodeDecodeError as e:
            out.append(raw[at : at + e.start].decode() + "�")
            at += e.start + 1
    return "".join(out)


class _Coder:
    """Encodes slices of texts; keeps the encodings of chunks."""

    def __init__(self, model: PieceModel):
        self.model = model
        self.forget()

    def forget(self) -> None:
        self.code: dict[str, int] = {}
        self.decoded: list[str] = []
        self.size, self.width = [], []
        self.flat = np.zeros((3, 0), np.int32)

    def learn(self, chunks: set[str]) -> None:
        alone, columns = [], [self.flat]
        for chunks, ids in self._side_by_side(sorted(chunks, key=len), alone):
            have = ids >= 0
            n = have.sum(axis=1)
            width = np.where(have, self.model.n_bytes[ids], 0)
            end = np.cumsum(width, axis=1, dtype=np.int32)
            columns.append(np.stack([ids[have], (end - width)[have], end[have]]))
            self._keep(chunks, n.tolist(), end[:, -1].tolist(), columns[-1][0].tolist())
        found: tuple[list[int], list[int], list[int]] = ([], [], [])
        sizes = []
        for c in alone:
            own = self.model.encode_chunk(c)
            sizes.append(len(own[0]))
            for kept, more in zip(found, own, strict=True):
                kept += more
        self._keep(alone, sizes, [len(c.encode()) for c in alone], found[0])
        self.flat = np.concatenate([*columns, np.array(found, np.int32)], axis=1)

    def _keep(self, chunks: list[str], sizes: list[int], widths: list[int], ids: list[int]) -> None:
        self.code.update(zip(chunks, range(len(self.size), len(self.size) + len(chunks)), strict=True))
        at, show = 0, self.model.shown
        for n in sizes:
            self.decoded.append(show(ids[at : at + n]))
            at += n
        self.size += sizes
        self.width += widths

    def _side_by_side(self, chunks: list[str], alone: list[str]) -> Iterator[tuple[list[str], np.ndarray]]:
        """Chunks, by length, and their merged pieces as rows filled up with -1; the others go to ``alone``."""
        lengths = np.array([len(c) for c in chunks], np.int64)
        a = 0
        for most in SIDE_BY_SIDE if not self.model.unused else ():
            b = int(np.searchsorted(lengths, most, "right"))
            own, n = chunks[a:b], lengths[a:b]
            a = b
            if not own:
                continue
            points = np.frombuffer("".join(own).encode("utf-32-le"), "<u4")
            ids = np.full((len(own), most), -1, np.int32)
            chars = self.model.of_char[points]
            ids[np.repeat(np.arange(len(own)), n), np.arange(len(points)) - np.repeat(np.cumsum(n) - n, n)] = chars
            odd = np.logical_or.reduceat(chars < 0, np.cumsum(n) - n)
            alone += [own[i] for i in np.flatnonzero(odd).tolist()]
            yield [own[i] for i in np.flatnonzero(~odd).tolist()], self.model.merge_many(ids[~odd].T).T
        alone += chunks[a:]

    def encode(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, list[str]]:
        """Pieces of each text; ids, begins and ends of all of them; decoded texts."""
        cut, parts, aligns = self.model.cut, [], []
        for t in texts:
            norm, align = self.model.normalizer(t)
            norm = norm.decode()
            parts.append(cut.findall(norm) if cut else [norm] if norm else [])
            aligns.append(align)
        if len(self.code) > KEPT_CHUNKS:
            self.forget()
        if new := {c for p in parts for c in p} - self.code.keys():
            self.learn(new)
        get, shown = self.code.__getitem__, self.decoded.__getitem__
        codes = [list(map(get, p)) for p in parts]
        decoded = [self.model.whole("".join(map(shown, c))) for c in codes]
        c = np.concatenate([np.zeros(0, np.int64), *(np.array(x, np.int64) for x in codes)])
        doc = np.repeat(np.arange(len(parts)), [len(x) for x in codes])
        sizes, width = np.array(self.size, np.int64), np.array(self.width, np.int64)
        n = sizes[c]
        total = int(n.sum())
        at = np.repeat(np.cumsum(sizes)[c] - n - (np.cumsum(n) - n), n) + np.arange(total)
        # a document has one place more in its alignment than normalised bytes
        base = np.repeat(np.cumsum(width[c]) - width[c] + doc, n)
        align = np.concatenate([np.zeros(0, np.int32), *aligns])
        counts = np.bincount(doc, weights=n, minlength=len(parts)).astype(np.int64)
        ids, begins, ends = self.flat[:, at]
        return counts, ids, align[begins + base], align[ends + base], decoded


def _encode(model):
    def encode(batches):
        coder = _Coder(PieceModel(model.value))
        for batch in batches:
            data, offsets = text_buffers(batch["text"])
            for a, b in slices(offsets, SLICE_BYTES):
                o = (offsets[a : b + 1] - offsets[a]).tolist()
                raw = data[offsets[a] : offsets[b]].tobytes()
                counts, *cols, decoded = coder.encode([raw[x:y] for x, y in zip(o, o[1:], strict=False)])
                ends = pa.array(np.concatenate([[0], np.cumsum(counts)]), pa.int32())
                lists = [pa.ListArray.from_arrays(ends, pa.array(x, pa.int32())) for x in cols]
                yield pa.RecordBatch.from_arrays([batch["id"].slice(a, b - a), pa.array(counts), *lists, pa.array(decoded, pa.string())], ["id", "n_tokens", "ids", "begins", "ends", "decoded"])

    return encode


def model_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def encode_pieces(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row for each document: (id, n_tokens, ids, begins, ends, decoded). Piece k covers the bytes
    [begins[k], ends[k]) of the text in UTF-8; ``decoded`` is the text that the ids decode to."""
    with open(path, "rb") as f:
        model = docs.sparkSession.sparkContext.broadcast(f.read())
    kept = docs.select(named(id_col).alias("id"), named(text_col).alias("text"))
    schema = StructType([kept.schema["id"], *StructType.fromDDL("n_tokens bigint, ids array<int>, begins array<int>, ends array<int>, decoded string")])
    return kept.mapInArrow(_encode(model), schema)


def digests(encoded: DataFrame) -> DataFrame:
    listed = F.array_join(F.col("ids").cast("array<string>"), ",")
    return encoded.select(F.col("id").alias("doc_id"), "n_tokens", F.sha2(listed, 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


def op12_sentencepiece_coding(spark, sf_dir: str) -> DataFrame:
    return digests(encode_pieces(spark.read.parquet(f"{sf_dir}/documents.parquet"), model_path()))
