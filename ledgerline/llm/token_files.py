"""Token ids in seekable Zstandard files: a frame per document and a seek table at the end.

A file holds, in ascending order of documents,

* one independent Zstandard frame per document, its ids as little-endian unsigned 32-bit
  integers;
* a skippable frame with the documents' ids: their number (unsigned 64 bits), a byte per
  document that is 1 where the id is null, and the ids (signed 64 bits);
* the seek table of the seekable format, also a skippable frame: per frame before it the
  compressed and the decompressed size and the lower half of XXH64 of the content
  (unsigned 32 bits each), then the number of frames, a byte 0x80 (checksums are there)
  and the magic number.

So a reader needs the end of a file, and the frames of the documents it wants.
"""

import os
import re
import struct
from array import array
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from ledgerline.llm.files import file_system, new_name, shared_folder
from ledgerline.llm.shared import gathered, map_in_arrow, text_of, text_slices, written

END_ID = 0
LEVEL = 1
# Fixed by the seekable format.
SKIPPABLE = 0x184D2A50
SEEK_TABLE = 0x184D2A5E
SEEKABLE = 0x8F92EAB1
CHECKSUMS = 0x80
ENTRY, FOOTER = 12, 9

# Pieces remembered per Python worker, twice at most: the last and the present generation.
REMEMBERED = 250_000
SLICE_CHARS = 2_000_000


# New pieces that the library gets as one text.
TOGETHER = 500
# Stands for a line feed that begins a piece, and for the beginning of a text.
LINE, START = "\0", "\1"
_LINE_FEED = re.compile(r"\n(?=\S)(?<=\S\n)")


class ByteBpe:
    """Encodes with the tokenizers library, each piece between single blanks just once.

    Arrow numbers the pieces of many texts, so Python looks at distinct ones only.

    The pre-tokenizer ends a token before a single blank between two other characters, so
    a blank and what follows it is encoded alone as within its text. It ends one before and
    after a single line feed as well, so a line feed and what follows it is another piece.
    Pieces for which that
    does not hold, next to other white space, are encoded together with their neighbours.
    The first piece of a text has no blank before it and is remembered apart.
    """

    def __init__(self, path):
        self.library = Tokenizer.from_file(path)
        self.library.no_truncation()
        self.library.no_padding()
        vocabulary = self.library.get_vocab()
        self.begins = np.zeros(max(vocabulary.values()) + 1, dtype=bool)
        # The byte-level form of a blank.
        self.begins[[i for token, i in vocabulary.items() if token.startswith("\u0120")]] = True
        self.now, self.last = {}, {}

    def _library(self, chunks):
        encoded = self.library.encode_batch_fast(chunks, add_special_tokens=False)
        return [array("I", e.ids).tobytes() for e in encoded]

    def _new(self, pieces):
        """The ids of each piece after a blank: of many at once, parted where a blank begins."""
        out = []
        groups = [pieces[i : i + TOGETHER] for i in range(0, len(pieces), TOGETHER)]
        for group, ids in zip(groups, self._library([" " + " ".join(g) for g in groups]), strict=True):
            starts = np.flatnonzero(self.begins[np.frombuffer(ids, dtype="<u4")]) * 4
            if len(starts) != len(group):
                out += self._library([" " + p for p in group])
                continue
            ends = [*starts[1:].tolist(), len(ids)]
            out += [ids[a:b] for a, b in zip(starts.tolist(), ends, strict=True)]
        return out

    def _remember(self, pieces):
        """Has the ids of a blank and each piece in ``self.now``, None where it needs more."""
        if len(self.now) > REMEMBERED:
            self.now, self.last = {}, self.now
        missing = []
        for p in [p for p in pieces if p not in self.now]:
            core = p[1:] if p.startswith((LINE, START)) else p
            if p in self.last:
                self.now[p] = self.last[p]
            elif not core or core != core.strip():
                self.now[p] = None
            else:
                missing.append(p)
        for sign, before in ((LINE, "\n"), (START, "")):
            some = [p for p in missing if p[0] == sign]
            self.now.update(zip(some, self._library([before + p[1:] for p in some]), strict=True))
        blanks = [p for p in missing if p[0] not in (LINE, START)]
        self.now.update(zip(blanks, self._new(blanks), strict=True))

    def _apart(self, pieces):
        """The ids of a text some of whose pieces belong together."""
        chunks, chunk = [], pieces[0]
        for piece in pieces[1:]:
            if chunk and piece and not chunk[-1].isspace() and not piece[0].isspace():
                chunks.append(chunk)
                chunk = " " + piece
            else:
                chunk += " " + piece
        chunks.append(chunk)
        return b"".join(self._library(chunks))

    def encode(self, texts):
        """The ids of each text as bytes."""
        # A text that holds a sign itself is encoded as one whose pieces belong together.
        marked = [
            START if LINE in t or START in t else START + _LINE_FEED.sub(" " + LINE, t)
            for t in texts
        ]
        pieces = pc.split_pattern(pa.array(marked, pa.string()), " ")
        numbered = pieces.flatten().dictionary_encode()
        distinct = numbered.dictionary.to_numpy(zero_copy_only=False).tolist()
        self._remember(distinct)
        made = list(map(self.now.__getitem__, distinct))
        number = numbered.indices.to_numpy()
        apart = np.array([m is None for m in made])[number]
        made = [m or b"" for m in made]
        sizes = np.fromiter(map(len, made), dtype=np.int64, count=len(made)) // 4
        ids, ends = gathered(np.frombuffer(b"".join(made), dtype="<u4"), sizes, number)
        places = pieces.offsets.to_numpy()
        borders = np.concatenate([[0], ends])[places].tolist()
        apart = np.logical_or.reduceat(apart, places[:-1]).tolist() if len(texts) else []
        return [
            self._apart(text.split(" ")) if alone else ids[a:b].tobytes()
            for text, alone, a, b in zip(texts, apart, borders, borders[1:], strict=False)
        ]


@lru_cache(maxsize=2)
def tokenizer(path):
    # A task has a core of its own; the library would take all of the machine's.
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    return ByteBpe(path)


def _skippable(magic, content):
    return struct.pack("<II", magic, len(content)) + content


class FileWriter:
    """Writes one file, frame by frame."""

    def __init__(self, sink):
        self.sink = sink
        self.compressor = zstandard.ZstdCompressor(level=LEVEL)
        self.entries, self.ids = [], []

    def add(self, doc_id, ids):
        frame = self.compressor.compress(ids)
        self.sink.write(frame)
        self.entries.append((len(frame), len(ids), xxhash.xxh64_intdigest(ids) & 0xFFFFFFFF))
        self.ids.append(doc_id)

    def close(self):
        nulls = np.array([i is None for i in self.ids], dtype=np.uint8)
        ids = np.array([i or 0 for i in self.ids], dtype="<i8")
        index = _skippable(
            SKIPPABLE, struct.pack("<Q", len(ids)) + nulls.tobytes() + ids.tobytes()
        )
        self.sink.write(index)
        entries = np.array([*self.entries, (len(index), 0, 0)], dtype="<u4")
        footer = struct.pack("<IBI", len(entries), CHECKSUMS, SEEKABLE)
        self.sink.write(_skippable(SEEK_TABLE, entries.tobytes() + footer))


class FileReader:
    """Reads the ends of a file, then the frames asked for."""

    def __init__(self, source):
        self.source = source
        self.decompressor = zstandard.ZstdDecompressor()
        end = source.size()
        frames, flags, magic = struct.unpack("<IBI", self._read(end - FOOTER, FOOTER))
        if magic != SEEKABLE or flags != CHECKSUMS:
            raise ValueError("not a token file with checksums")
        table = self._read(end - FOOTER - ENTRY * frames, ENTRY * frames)
        self.entries = np.frombuffer(table, dtype="<u4").reshape(frames, 3).astype(np.int64)
        self.starts = np.concatenate([[0], np.cumsum(self.entries[:, 0])])
        index = self._read(int(self.starts[-2]) + 8, int(self.entries[-1, 0]) - 8)
        (n,) = struct.unpack("<Q", index[:8])
        nulls = np.frombuffer(index[8 : 8 + n], dtype=np.uint8)
        ids = np.frombuffer(index[8 + n :], dtype="<i8")
        self.ids = [None if gone else i for i, gone in zip(ids.tolist(), nulls, strict=True)]
        self.first = np.concatenate([[0], np.cumsum(self.entries[:-1, 1] // 4)])

    def _read(self, start, size):
        self.source.seek(start)
        return self.source.read(size)

    def document(self, at):
        """The ids of the document at this place of the file, checked, as bytes."""
        size, whole, checksum = (int(x) for x in self.entries[at])
        frame = self._read(int(self.starts[at]), size)
        ids = self.decompressor.decompress(frame, max_output_size=whole) if whole else b""
        if len(ids) != whole or xxhash.xxh64_intdigest(ids) & 0xFFFFFFFF != checksum:
            raise ValueError(f"frame {at} is damaged")
        return ids


def write_tokens(docs, path, folder=None):
    """Write the ids of all ``docs`` into files; (part, file, n_docs, n_ids) of each.

    ``path`` is the tokenizer file, on every executor. Files are in ascending order of
    doc_id, null first, equal ids by the hash of their text; ``part`` rises with it. Each
    document ends with id 0, a null or empty text is just that. Repeated rows are written
    each. Empty parts have no file. Only ``doc_id`` and ``text`` are read.
    """
    spark = docs.sparkSession
    folder = folder or shared_folder(spark, "tokens")

    def each(batches):
        bpe = tokenizer(path)
        part = TaskContext.get().partitionId()
        name, sink, writer, n_ids = None, None, None, 0
        end = np.array([END_ID], dtype="<u4").tobytes()
        for batch in batches:
            ids, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for start, stop in text_slices(texts, SLICE_CHARS):
                for doc_id, made in zip(
                    ids[start:stop], bpe.encode(texts[start:stop]), strict=True
                ):
                    if writer is None:
                        system, root = file_system(folder)
                        system.create_dir(root, recursive=True)
                        name = new_name("tokens", part, ".zst")
                        sink = system.open_output_stream(f"{root}/{name}", compression=None)
                        writer = FileWriter(sink)
                    writer.add(doc_id, made + end)
                    n_ids += len(made) // 4 + 1
        if writer is not None:
            writer.close()
            sink.close()
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([part], pa.int64()),
                    pa.array([f"{folder}/{name}"]),
                    pa.array([len(writer.ids)], pa.int64()),
                    pa.array([n_ids], pa.int64()),
                ],
                ["part", "file", "n_docs", "n_ids"],
            )

    rows = docs.select(F.col("doc_id").cast("long"), text_of().alias("text"))
    placed = rows.withColumn("_tie", F.xxhash64("text"))
    ordered = placed.repartitionByRange("doc_id", "_tie").sortWithinPartitions("doc_id", "_tie")
    return written(
        map_in_arrow(
            ordered.select("doc_id", "text"), each, "part long, file string, n_docs long, n_ids long"
        ),
        "token-files",
    )


def read_tokens(files, wanted=None):
    """(part, doc_id, at, ids binary) of documents in ``files``, the result of writing.

    ``at`` is the number of ids before the document in its file. ``wanted``: a set of
    doc_ids, small enough to be sent along; only their frames are read then.
    """

    def each(batches):
        for batch in batches:
            parts, names = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for part, name in zip(parts, names, strict=True):
                system, place = file_system(name)
                with system.open_input_file(place) as source:
                    reader = FileReader(source)
                    chosen = [
                        i for i, d in enumerate(reader.ids) if wanted is None or d in wanted
                    ]
                    for start in range(0, len(chosen), 500):
                        some = chosen[start : start + 500]
                        yield pa.RecordBatch.from_arrays(
                            [
                                pa.array([part] * len(some), pa.int64()),
                                pa.array([reader.ids[i] for i in some], pa.int64()),
                                pa.array([int(reader.first[i]) for i in some], pa.int64()),
                                pa.array([reader.document(i) for i in some], pa.binary()),
                            ],
                            ["part", "doc_id", "at", "ids"],
                        )

    spark = files.sparkSession
    # One task per file: a file holds what one task has written.
    spread = files.select("part", "file").repartitionByRange(
        max(1, min(files.count(), spark.sparkContext.defaultParallelism * 8)), "part"
    )
    return map_in_arrow(spread, each, "part long, doc_id long, at long, ids binary")


def token_index(docs, path):
    """Per document, from files written and read back: doc_id, start, n_tokens, ids_crc32.

    ``start`` counts the ids of all documents before it in ascending order of doc_id.
    """
    files = write_tokens(docs, path)
    parts = files.select("part", "n_ids").orderBy("part").collect()  # one row per file
    starts, total = [], 0
    for row in parts:
        starts.append((row["part"], total))
        total += row["n_ids"]
    offsets = files.sparkSession.createDataFrame(starts, "part long, before long")
    return (
        read_tokens(files)
        .join(F.broadcast(offsets), "part")
        .select(
            "doc_id",
            (F.col("before") + F.col("at")).alias("start"),
            (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
            F.crc32("ids").alias("ids_crc32"),
        )
    )
