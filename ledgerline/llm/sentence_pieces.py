"""SentencePiece encoding that knows the place of every piece in the original text.

The compiled character map of the model rewrites a text by the longest prefix it knows at
each place and records, for every byte of the result, where it came from. The rewritten text
is merged to pieces; each piece's bytes are projected through that record to the bytes of the
original. Chunks that no merge can cross are remembered, within a fixed bound; merging
new ones is left to the library, on text that is rewritten already.
"""

import re
from array import array
from functools import lru_cache
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F
from sentencepiece import SentencePieceProcessor, sentencepiece_model_pb2

from ledgerline.llm.shared import map_in_arrow, text_of, text_slices

# Chunks remembered per Python worker, twice at most: the last and the present generation.
REMEMBERED = 150_000
# Longer chunks are not remembered.
LONG_CHUNK = 100
SPACE = "▁"


class CharacterMap:
    """The rules of a compiled map: a double array of their bytes, then the texts they yield."""

    def __init__(self, compiled):
        size = int.from_bytes(compiled[:4], "little")
        self.units = np.frombuffer(compiled[4 : 4 + size], dtype="<u4").tolist()
        self.texts = compiled[4 + size :]
        firsts = [b for b in range(1, 256) if self.units and self._child(0, b) is not None]
        self.starts = re.compile(b"[" + re.escape(bytes(firsts)) + b"]") if firsts else None

    def _child(self, node, byte):
        """The node below ``node`` by ``byte``, or None."""
        unit = self.units[node]
        child = node ^ (unit >> 10) << ((unit & 1 << 9) >> 6) ^ byte
        if child < len(self.units) and self.units[child] & 0x800000FF == byte:
            return child
        return None

    def longest(self, data, at):
        """What the longest rule at a place yields and how many bytes it takes, or None."""
        node, found = 0, None
        for taken, byte in enumerate(data[at:], 1):
            node = self._child(node, byte)
            if node is None:
                break
            unit = self.units[node]
            if unit >> 8 & 1:
                leaf = self.units[node ^ (unit >> 10) << ((unit & 1 << 9) >> 6)]
                found = leaf & 0x7FFFFFFF, taken
        if found is None:
            return None
        return self.texts[found[0] : self.texts.index(b"\0", found[0])], found[1]

    def rewritten(self, data):
        """(what it yields, first byte, bytes taken) for consecutive pieces of ``data``."""
        at = 0
        while at < len(data):
            rule = self.longest(data, at) if self.starts else None
            if rule is None:
                taken = 1
                while at + taken < len(data) and data[at + taken] & 0xC0 == 0x80:
                    taken += 1
                rule = data[at : at + taken], taken
            yield rule[0], at, rule[1]
            at += rule[1]


class PieceModel:
    """Encodes as the library does with the model at ``path``: BPE with byte fallback.

    Models with pieces of the user, unused pieces, another algorithm, white space as a suffix
    or a map for decoding raise ValueError.
    """

    def __init__(self, path):
        proto = sentencepiece_model_pb2.ModelProto()
        with open(path, "rb") as file:
            proto.ParseFromString(file.read())
        kinds = proto.SentencePiece
        trained, rules = proto.trainer_spec, proto.normalizer_spec
        if (
            trained.model_type != trained.BPE
            or not trained.byte_fallback
            or trained.treat_whitespace_as_suffix
            or not rules.escape_whitespaces
            or proto.denormalizer_spec.precompiled_charsmap
            or any(p.type in (kinds.USER_DEFINED, kinds.UNUSED) for p in proto.pieces)
        ):
            raise ValueError(f"Not a model this operator reads: {path}")
        self.map = CharacterMap(rules.precompiled_charsmap)
        self.prefix = rules.add_dummy_prefix
        self.trims = rules.remove_extra_whitespaces
        names = [p.piece for p in proto.pieces]
        normal = [p.type == kinds.NORMAL for p in proto.pieces]
        by_name = {p.piece: i for i, p in enumerate(proto.pieces) if p.type == kinds.BYTE}
        byte_ids = [by_name[f"<0x{b:02X}>"] for b in range(256)]
        self.byte_of = np.full(len(names), -1, dtype=np.int32)
        self.byte_of[byte_ids] = np.arange(256)
        self.bytes_taken = np.ones(len(names), dtype=np.int64)
        # What each piece adds to a decoded text; byte pieces add a byte.
        self.raw = [b""] * len(names)
        self.blank = [False] * len(names)
        for i, name in enumerate(names):
            if normal[i]:
                self.bytes_taken[i] = len(name.encode())
                self.raw[i] = name.replace(SPACE, " ").encode()
                self.blank[i] = name.startswith(SPACE)
            elif self.byte_of[i] >= 0:
                self.raw[i] = bytes([self.byte_of[i]])
            elif proto.pieces[i].type == kinds.UNKNOWN:
                self.raw[i] = trained.unk_surface.encode()
        self.is_byte = (self.byte_of >= 0).tolist()
        self.chunks = self._chunk_pattern([n for n, known in zip(names, normal, strict=True) if known])
        self.now, self.last = {}, {}
        # Merges text as it is: rewriting has been done.
        rules.precompiled_charsmap = b""
        rules.add_dummy_prefix = rules.remove_extra_whitespaces = False
        self.library = SentencePieceProcessor(model_proto=proto.SerializeToString())

    @staticmethod
    def _chunk_pattern(names):
        """Splits a rewritten text where no piece reaches over: before blanks, around lines."""
        if any(SPACE in name.lstrip(SPACE) for name in names):
            return re.compile(r".+", re.DOTALL)
        alone = "" if any("\n" in name and len(name) > 1 for name in names) else r"\n"
        return re.compile(rf"{SPACE}*[^{SPACE}{alone}]+|{SPACE}+" + (rf"|{alone}" if alone else ""))

    # Rewriting -----------------------------------------------------------------

    def normal(self, data):
        """The rewritten text of UTF-8 ``data``, and where each of its bytes, and the end, lie in it."""
        if not data:
            return "", np.zeros(1, dtype=np.int32)
        if self.map.starts is None and not self.trims:
            codes = np.frombuffer(data, dtype=np.uint8)
            begin = 3 * self.prefix
            places = np.repeat(np.arange(len(data), dtype=np.int32), 1 + 2 * (codes == 0x20))
            ends = np.zeros(begin, dtype=np.int32), places, [len(data)]
            text = SPACE * self.prefix + data.decode().replace(" ", SPACE)
            return text, np.concatenate(ends).astype(np.int32)
        return self._rewritten(data)

    def _rewritten(self, data):
        out, places, end, begun = [], [], 0, False
        blank, after_blank = SPACE.encode(), self.trims
        for text, at, taken in self.map.rewritten(data):
            if self.trims and not begun and text == b" ":
                end = at + taken
                continue
            if not begun:
                begun = True
                if self.prefix:
                    out.append(blank)
                    places += [at] * len(blank)
            if after_blank:
                text = text.lstrip(b" ")
            if text:
                after_blank = self.trims and text.endswith(b" ")
                text = text.replace(b" ", blank)
                out.append(text)
                places += [at] * len(text)
            end = at + taken
        whole = b"".join(out)
        if self.trims:
            while whole.endswith(blank):
                whole = whole[: -len(blank)]
                end = places[len(whole)]
        return whole.decode(), np.array([*places[: len(whole)], end], dtype=np.int32)

    # Whole texts ---------------------------------------------------------------

    def _remember(self, chunks):
        """Has the ids of every chunk, as int32 bytes, in ``self.now``; and those that may not stay."""
        if len(self.now) > REMEMBERED:
            self.now, self.last = {}, self.now
        new = []
        for chunk in chunks:
            if chunk not in self.now:
                ids = self.last.get(chunk)
                if ids is None:
                    new.append(chunk)
                else:
                    self.now[chunk] = ids
        for chunk, ids in zip(new, self.library.encode(new, num_threads=1), strict=True):
            self.now[chunk] = array("i", ids).tobytes()
        return [c for c in new if len(c) > LONG_CHUNK]

    def encode(self, texts):
        """Per text its ids, and the first byte and the end of each piece in its UTF-8 form.

        A character in byte pieces belongs to the last of them; the others are empty.
        """
        normal = [self.normal(text.encode()) for text in texts]
        found = [self.chunks.findall(text) for text, _ in normal]
        too_long = self._remember(set().union(*found))
        out = [
            self._placed(b"".join(map(self.now.__getitem__, chunks)), places)
            for chunks, (_, places) in zip(found, normal, strict=True)
        ]
        for chunk in too_long:
            del self.now[chunk]
        return out

    def _placed(self, ids, places):
        """Ids with the places that ``places`` gives the bytes of their pieces."""
        ids = np.frombuffer(ids, dtype="<i4")
        edges = np.concatenate([[0], np.cumsum(self.bytes_taken[ids])])
        starts, ends = places[edges[:-1]], places[edges[1:]]
        byte = self.byte_of[ids]
        if (byte >= 0).any():
            follows = (byte >= 0x80) & (byte < 0xC0)
            lead = np.maximum.accumulate(np.where(follows, 0, np.arange(len(ids))))
            starts = starts[lead]
            inner = np.concatenate([follows[1:], [False]])
            ends = np.where(inner, starts, ends)
        return ids, starts, ends

    def decode(self, ids):
        """The text of ``ids`` as the library puts it together, one leading blank less."""
        out, at, takes = b"", 0, self.prefix or self.trims
        while takes and not out and at < len(ids) and not self.is_byte[ids[at]]:
            out = self.raw[ids[at]]
            if self.blank[ids[at]]:
                out, takes = out[1:], self.trims
            at += 1
        rest = ids[at:]
        try:
            return (out + b"".join(map(self.raw.__getitem__, rest))).decode()
        except UnicodeDecodeError:
            pass
        # Some bytes make no character: each run of byte pieces is read by itself.
        parts = [out.decode()]
        for is_byte, run in groupby(rest, self.is_byte.__getitem__):
            run = b"".join(map(self.raw.__getitem__, run))
            parts.append(_lenient(run) if is_byte else run.decode())
        return "".join(parts)


def _lenient(data):
    """UTF-8 text; every byte that begins no character is U+FFFD."""
    out, at = [], 0
    while at < len(data):
        for size in (1, 2, 3, 4):
            try:
                out.append(data[at : at + size].decode())
                at += size
                break
            except UnicodeDecodeError:
                pass
        else:
            out.append("�")
            at += 1
    return "".join(out)


@lru_cache(maxsize=2)
def model(path):
    return PieceModel(path)


def encode_decode(docs, path):
    """(doc_id, ids, starts, ends, decoded) per row of ``docs``.

    ``ids`` are the pieces' ids, ``starts`` and ``ends`` their bytes in the UTF-8 text, and
    ``decoded`` is the text made of the ids. ``path`` is the model file, on every executor.

    A null text is an empty one, with no ids and the empty string; a null doc_id is kept;
    repeated rows are encoded alike; an empty table gives no rows. Texts of any length are
    encoded whole. Only ``doc_id`` and ``text`` are read.
    """

    def each(batches):
        pieces = model(path)
        for batch in batches:
            texts = batch.column(1).to_pylist()
            for start, end in text_slices(texts):
                encoded = pieces.encode(texts[start:end])
                offsets = np.cumsum([0, *(len(e[0]) for e in encoded)]).astype(np.int32)
                lists = [
                    pa.ListArray.from_arrays(
                        pa.array(offsets), pa.array(np.concatenate([e[k] for e in encoded]))
                    )
                    for k in range(3)
                ]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(start, end - start),
                        *lists,
                        pa.array([pieces.decode(e[0].tolist()) for e in encoded], pa.string()),
                    ],
                    ["doc_id", "ids", "starts", "ends", "decoded"],
                )

    rows = docs.select(F.col("doc_id").cast("long"), text_of().alias("text"))
    schema = "doc_id long, ids array<int>, starts array<int>, ends array<int>, decoded string"
    return map_in_arrow(rows, each, schema)


def _sum(column):
    return F.aggregate(column, F.lit(0).cast("long"), lambda total, x: total + x)


def digest(encoded):
    """Per row of :func:`encode_decode`: n_tokens, SHA-256 of ids and decoded text, covered_bytes.

    ``covered_bytes`` counts the bytes of the original text that the pieces' spans cover.
    """
    return encoded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
        (_sum("ends") - _sum("starts")).alias("covered_bytes"),
    )
