import random
import struct
import zlib

import public_tokenizers
import pytest
from corpus_for_tests import AWKWARD, awkward, empty, texts
from pyarrow import BufferReader, BufferOutputStream
from tokenizers import Tokenizer

from ledgerline.llm.token_files import (
    ByteBpe,
    FileReader,
    FileWriter,
    read_tokens,
    token_index,
    write_tokens,
)

PATH = public_tokenizers.path("byte_bpe_50k.json")


def expected(rows):
    """Ascending by id, null first; equal ids differ in their place alone."""
    library, start, out = Tokenizer.from_file(PATH), 0, []
    for i, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0)):
        ids = [*library.encode(text or "", add_special_tokens=False).ids, 0]
        out.append((i, start, len(ids), zlib.crc32(struct.pack(f"<{len(ids)}I", *ids))))
        start += len(ids)
    return out


def test_round_trip(spark):
    rng = random.Random(1)
    listed = [
        "", " ", "  a", " a", "a ", "a  b", "a\n b", "a \n b", "　a \x1c b\x85 c", "a\xa0 b", None,
        "it's  <|endoftext|> x<|endoftext|>y <|endoftext|>",
    ]
    letters = "ab'st  \n\t1!é　\x1c<|endoftext|>"
    listed += ["".join(rng.choice(letters) for _ in range(200)) for _ in range(150)]
    out = token_index(texts(spark, listed).repartition(3), PATH).collect()
    assert sorted(map(tuple, out)) == sorted(expected(enumerate(listed)))


def test_pieces_of_many_texts_equal_the_library():
    """Pieces that are new, known and forgotten; line feeds of all kinds; the sign of one."""
    rng = random.Random(4)
    library = Tokenizer.from_file(PATH)
    own = ByteBpe(PATH)
    own.last = {}
    breaks = [" ", " ", " ", "\n", "\n", "\n\n", " \n", "\n ", "\t", "  ", "\r\n", "\x1c", "\x85"]
    for round_ in range(6):
        listed = ["x\0y z\n\0w", "\0", "a\n", "\na", "a\nb", "a\n\0b c", ""]
        for _ in range(300):
            words = ["".join(rng.choice("abcdé1!,'.") for _ in range(rng.randint(1, 7))) for _ in range(30)]
            listed.append("".join(w + rng.choice(breaks[: rng.choice([3, 5, 13])]) for w in words))
        got = own.encode(listed)
        assert got == [
            struct.pack(f"<{len(e.ids)}I", *e.ids)
            for e in library.encode_batch(listed, add_special_tokens=False)
        ]


def test_awkward_rows(spark):
    out = sorted(map(tuple, token_index(awkward(spark), PATH).collect()), key=lambda r: r[1])
    want = expected(AWKWARD)
    # Rows of one id are in an order of their own, so their starts differ.
    assert sorted((r[0] or -1, r[2], r[3]) for r in out) == sorted(
        (r[0] or -1, r[2], r[3]) for r in want
    )
    assert [r[0] for r in out] == [r[0] for r in want]
    assert [r[1] for r in out] == [sum(r[2] for r in out[:i]) for i in range(len(out))]
    assert token_index(empty(spark), PATH).collect() == []


def test_only_wanted_frames_are_read(spark):
    files = write_tokens(texts(spark, [f"text {i}" for i in range(50)]), PATH)
    out = read_tokens(files, wanted={3, 40, 99}).collect()
    assert sorted(r["doc_id"] for r in out) == [3, 40]

    sink = BufferOutputStream()
    writer = FileWriter(sink)
    for i in range(20):
        writer.add(i, struct.pack("<300I", *range(i, i + 300)))
    writer.close()
    data = sink.getvalue().to_pybytes()
    asked = []

    class Watched(BufferReader):
        def read(self, size=None):
            asked.append((self.tell(), size))
            return super().read(size)

    reader = FileReader(Watched(data))
    asked.clear()
    assert reader.document(7) == struct.pack("<300I", *range(7, 307))
    assert asked == [(int(reader.starts[7]), int(reader.entries[7, 0]))]
    # Any reader of the plain format sees the concatenated frames.
    import zstandard

    whole = zstandard.ZstdDecompressor().stream_reader(data, read_across_frames=True).read()
    assert whole == b"".join(reader.document(i) for i in range(20))


def test_damage_is_noticed():
    sink = BufferOutputStream()
    writer = FileWriter(sink)
    writer.add(1, bytes(4000))
    writer.close()
    data = bytearray(sink.getvalue().to_pybytes())
    reader = FileReader(BufferReader(bytes(data)))
    reader.entries[0, 2] ^= 1
    with pytest.raises(ValueError, match="damaged"):
        reader.document(0)
    with pytest.raises(ValueError, match="not a token file"):
        FileReader(BufferReader(bytes(data[:-1])))


def test_known_texts_do_not_go_to_the_library_again(monkeypatch):
    """The first piece of a text is remembered as well, apart from the same one after a blank."""
    own, library = ByteBpe(PATH), Tokenizer.from_file(PATH)
    texts = ["hello hello world\nhello", "world", "\1 a", "hello"]
    first = own.encode(texts)
    calls, call = [], own._library
    monkeypatch.setattr(own, "_library", lambda chunks: calls.extend(chunks) or call(chunks))
    assert own.encode([texts[0], texts[1], texts[3]]) == [first[0], first[1], first[3]]
    assert calls == []
    assert first == [
        struct.pack(f"<{len(e.ids)}I", *e.ids)
        for e in library.encode_batch(texts, add_special_tokens=False)
    ]
