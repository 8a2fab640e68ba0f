"""BPE encoding and decoding by speculating and verifying.

Words come from the tokenizer's normaliser and pattern. For each word the longest tokens that
match, taken greedily from the left, are a guess. The guess is what merging gives exactly if
no merge ever crosses the border of two neighbouring tokens, which depends on the two tokens
alone; all distinct pairs of a batch are tested at once. Only words with a failing pair are
merged exactly. All three steps work on arrays of many words, a byte, a pair or a merge of
each at a time. Chunks between blanks are remembered, within a fixed bound.
"""

import heapq
import json
import re
import unicodedata
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from ledgerline.llm.shared import gathered, map_in_arrow, runs, text_of

# Chunks remembered per Python worker, twice at most: the last and the present generation.
REMEMBERED = 50_000
SLICE_BYTES = 500_000
LONG_WORD = 500
# Words up to this many bytes go byte by byte beside each other, longer ones one by one.
BESIDE = 48
NEVER = np.iinfo(np.int64).max
# The tokenizer's white space has no separators U+001C to U+001F, unlike Python's.
_SPACE = "\\t-\\r \\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000"
# What stands between two chunks in a list of words.
BLANK = b" "


def _byte_symbols():
    """The character that stands for each byte: itself if printable, else one from 256 on."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    symbols, extra = {b: chr(b) for b in own}, 256
    for b in range(256):
        if b not in symbols:
            symbols[b] = chr(extra)
            extra += 1
    return [symbols[b] for b in range(256)]


class WordBpe:
    """Encodes texts as the tokenizer file at ``path`` does, without special tokens added."""

    def __init__(self, path):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model = spec["model"]
        self.suffix = model["end_of_word_suffix"]
        self.ids = model["vocab"]
        self.added = {t["content"]: t["id"] for t in spec["added_tokens"]}
        size = max([*self.ids.values(), *self.added.values()]) + 1
        self.tokens = [""] * size
        for token, i in [*self.ids.items(), *self.added.items()]:
            self.tokens[i] = token
        self.spelt = pa.array(self.tokens, pa.string())
        self.symbols = _byte_symbols()
        self.special = re.compile("(" + "|".join(map(re.escape, self.added)) + ")")
        pattern = spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"]
        # Chunks are split many at once, so the blank that parts them is found as well.
        self.pattern = regex.compile(pattern.replace(r"[^\s", f"[^{_SPACE}") + "| ")
        plain = pattern.replace(r"[^\s", r"[^\t-\r ").replace(r"\p{L}", "a-z").replace(r"\p{N}", "0-9")
        self.plain = re.compile(f"{plain}| ".encode("ascii"))
        self.known = set()
        self.rank, self.merged = {}, []
        for r, pair in enumerate(model["merges"]):
            left, right = pair if isinstance(pair, list) else pair.split(" ")
            self.rank[self.ids[left], self.ids[right]] = r
            self.merged.append(self.ids[left + right])
        self._trees(size)
        self.now, self.last = {}, {}
        self.path, self.library = path, None

    def _trees(self, size):
        """The last merge of every token that merging its own symbols yields."""
        self.left = np.full(size, -1)
        self.right = np.full(size, -1)
        self.made = np.full(size, -1)  # rank of the last merge, -1 for a symbol
        self.inner, self.final = {}, {}
        for token, i in self.ids.items():
            ends = token.endswith(self.suffix)
            word = token[: -len(self.suffix)] if ends else token
            whole, last = self._merge(self._symbol_ids(word, ends))
            if whole != [i]:
                continue
            if last:
                self.left[i], self.right[i], self.made[i] = last
            (self.final if ends else self.inner)[word] = i
        self.longest = max(map(len, [*self.inner, *self.final]))
        self.symbol = np.array([self.inner[c] for c in self.symbols])
        self.last_symbol = np.array([self.final[c] for c in self.symbols])
        pairs = np.array([a * size + b for a, b in self.rank])
        order = np.argsort(pairs)
        self.size, self.pairs = size, pairs[order]
        self.pair_rank = np.array(list(self.rank.values()))[order]
        self.merged = np.array(self.merged)
        self._paths()

    def _paths(self):
        """The tokens as a tree of their bytes: edges by (node, byte), and what a node spells."""
        byte = {c: b for b, c in enumerate(self.symbols)}
        edges = {}
        spelt = [[-1], [-1]]
        for which, tokens in enumerate((self.inner, self.final)):
            for token, i in tokens.items():
                node = 0
                for c in token:
                    key = node << 8 | byte[c]
                    node = edges.get(key)
                    if node is None:
                        node = edges[key] = len(spelt[0])
                        spelt[0].append(-1)
                        spelt[1].append(-1)
                spelt[which][node] = i
        keys = np.fromiter(edges, dtype=np.int64, count=len(edges))
        order = np.argsort(keys)
        self.edges = keys[order]
        self.to = np.fromiter(edges.values(), dtype=np.int64, count=len(edges))[order]
        self.inner_at, self.final_at = (np.array(x) for x in spelt)

    def _symbol_ids(self, word, ends=True):
        ids = [self.ids[c] for c in word[:-1]]
        return [*ids, self.ids[word[-1] + self.suffix if ends else word[-1]]]

    def _merge(self, ids):
        """Exact merging: always the lowest rank, the leftmost of equals. And the last merge."""
        if len(ids) > LONG_WORD:
            return self._merge_long(ids), None
        rank, last = self.rank, None
        ranks = [rank.get(p, NEVER) for p in zip(ids, ids[1:], strict=False)]
        while ranks and (r := min(ranks)) < NEVER:
            at = ranks.index(r)
            last = ids[at], ids[at + 1], r
            ids[at : at + 2] = [int(self.merged[r])]
            del ranks[at]
            if at:
                ranks[at - 1] = rank.get((ids[at - 1], ids[at]), NEVER)
            if at < len(ranks):
                ranks[at] = rank.get((ids[at], ids[at + 1]), NEVER)
        return ids, last

    def _merge_long(self, ids):
        """The same with a heap, for words whose pairs are too many to search each time."""
        rank, n = self.rank, len(ids)
        after, before = [*range(1, n), -1], [*range(-1, n - 1)]
        heap = [
            (r, at) for at, p in enumerate(zip(ids, ids[1:], strict=False)) if (r := rank.get(p)) is not None
        ]
        heapq.heapify(heap)
        while heap:
            r, at = heapq.heappop(heap)
            right = after[at]
            if ids[at] < 0 or right < 0 or rank.get((ids[at], ids[right])) != r:
                continue
            ids[at], ids[right] = int(self.merged[r]), -1
            after[at] = after[right]
            if after[at] >= 0:
                before[after[at]] = at
            for left in (before[at], at):
                if left >= 0 and after[left] >= 0:
                    new = rank.get((ids[left], ids[after[left]]))
                    if new is not None:
                        heapq.heappush(heap, (new, left))
        return [t for t in ids if t >= 0]

    def _greedy(self, word):
        """The longest match at each place; the last token is one that ends a word."""
        out, at, n = [], 0, len(word)
        inner, final = self.inner, self.final
        while at < n:
            rest = word[at:]
            token = final.get(rest)
            if token is not None:
                out.append(token)
                break
            for end in range(min(self.longest, n - at - 1), 0, -1):
                token = inner.get(rest[:end])
                if token is not None:
                    out.append(token)
                    at += end
                    break
        return out

    def _guesses(self, flat, starts, ends):
        """(word, token) of the longest matches of words at these places of ``flat`` bytes.

        All words go on by a byte at a time, until none of them has bytes left.
        """
        words, tokens = [], []
        live, cursor, end = np.arange(len(starts)), starts, ends
        node, best = np.zeros_like(starts), np.full_like(starts, -1)
        best_end = starts
        while len(live):
            key = node << 8 | flat[cursor]
            at = np.minimum(np.searchsorted(self.edges, key), len(self.edges) - 1)
            hit = self.edges[at] == key
            node, cursor = self.to[at], cursor + 1
            last = cursor == end
            done = hit & last & (self.final_at[node] >= 0)
            on = hit & ~last
            better = on & (self.inner_at[node] >= 0)
            best = np.where(better, self.inner_at[node], best)
            best_end = np.where(better, cursor, best_end)
            stop = ~on & ~done
            words += [live[done], live[stop]]
            tokens += [self.final_at[node[done]], best[stop]]
            cursor, node = np.where(on, cursor, best_end), np.where(on, node, 0)
            best = np.where(on, best, -1)
            left = ~done
            live, cursor, end, node = live[left], cursor[left], end[left], node[left]
            best, best_end = best[left], best_end[left]
        words, tokens = np.concatenate(words), np.concatenate(tokens)
        order = np.argsort(words, kind="stable")
        return words[order], tokens[order]

    def _ranks(self, a, b):
        """The ranks of pairs, NEVER for those without a merge."""
        key = a * self.size + b
        at = np.minimum(np.searchsorted(self.pairs, key), len(self.pairs) - 1)
        return np.where(self.pairs[at] == key, self.pair_rank[at], NEVER)

    def _merges(self, owner, ids):
        """Exact merging of many words' symbols, a merge of each word at a time."""
        made_owner, made_ids = [], []
        ranks = np.full(len(ids), NEVER)
        inside = np.flatnonzero(owner[1:] == owner[:-1])
        ranks[inside] = self._ranks(ids[inside], ids[inside + 1])
        while len(ids):
            begins = np.flatnonzero(np.concatenate([[True], owner[1:] != owner[:-1]]))
            sizes = np.diff(np.append(begins, len(ids)))
            lowest = np.minimum.reduceat(ranks, begins)
            going = lowest < NEVER
            if not going.all():
                stay = np.repeat(going, sizes)
                made_owner.append(owner[~stay])
                made_ids.append(ids[~stay])
                owner, ids, ranks = owner[stay], ids[stay], ranks[stay]
                sizes, lowest = sizes[going], lowest[going]
                if not len(ids):
                    break
            # The leftmost of the lowest pairs of each word.
            at = np.flatnonzero(ranks == np.repeat(lowest, sizes))
            at = at[np.concatenate([[True], owner[at[1:]] != owner[at[:-1]]])]
            ids[at] = self.merged[ranks[at]]
            keep = np.ones(len(ids), dtype=bool)
            keep[at + 1] = False
            owner, ids, ranks = owner[keep], ids[keep], ranks[keep]
            at -= np.arange(len(at))
            before = at[at > 0] - 1
            changed = np.concatenate([at, before])
            following = np.minimum(changed + 1, len(ids) - 1)
            fits = (owner[changed] == owner[following]) & (following > changed)
            ranks[changed] = np.where(fits, self._ranks(ids[changed], ids[following]), NEVER)
        return np.concatenate(made_owner), np.concatenate(made_ids)

    def compatible(self, a, b):
        """For arrays of tokens: whether no merge crosses the border of ``a`` and ``b``.

        Undoes the merges of both, the latest first. At each state the two pieces at the
        border stand side by side until the earlier of the merges that take them in; if
        they have a merge of lower rank (as low, for the right one's, since it is more to
        the left), it comes first and crosses.
        """
        good = np.ones(len(a), dtype=bool)
        live = np.arange(len(a))
        a, b = a.copy(), b.copy()
        taken_a, taken_b = np.full(len(a), NEVER), np.full(len(b), NEVER)
        while len(live):
            rank = self._ranks(a, b)
            crossed = (rank < taken_a) & (rank <= taken_b) & (rank < NEVER)
            good[live[crossed]] = False
            made_a, made_b = self.made[a], self.made[b]
            stay = ~crossed & ((made_a >= 0) | (made_b >= 0))
            undo_a = made_a > made_b
            taken_a = np.where(undo_a, made_a, taken_a)[stay]
            taken_b = np.where(undo_a, taken_b, made_b)[stay]
            a, b = np.where(undo_a, self.right[a], a)[stay], np.where(undo_a, b, self.left[b])[stay]
            live = live[stay]
        return good

    def _words(self, words):
        """(sizes, ids) of distinct words given as bytes: the number of ids of each, and all ids."""
        lengths = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
        flat = np.frombuffer(b"".join(words), dtype=np.uint8).astype(np.int64)
        ends = np.cumsum(lengths)
        beside = np.flatnonzero(lengths <= BESIDE)
        owner, ids = self._guesses(flat, (ends - lengths)[beside], ends[beside])
        owner = beside[owner]
        alone = [(w, self._greedy(self._in_symbols(words[w]))) for w in np.flatnonzero(lengths > BESIDE)]
        owner, ids = _joined(owner, ids, alone)
        inside = np.flatnonzero(owner[1:] == owner[:-1])
        pairs, which = np.unique(ids[inside] * self.size + ids[inside + 1], return_inverse=True)
        good = self.compatible(pairs // self.size, pairs % self.size)
        failed = np.zeros(len(words), dtype=bool)
        failed[owner[inside[~good[which]]]] = True
        if failed.any():
            kept = ~failed[owner]
            some = np.flatnonzero(failed & (lengths <= BESIDE))
            at = np.repeat(failed & (lengths <= BESIDE), lengths)
            symbols = self.symbol[flat[at]]
            last = ends[some] - 1
            symbols[np.cumsum(lengths[some]) - 1] = self.last_symbol[flat[last]]
            exact = [(owner[kept], ids[kept])]
            if len(some):
                exact.append(self._merges(np.repeat(some, lengths[some]), symbols))
            alone = [
                (w, self._merge(self._symbol_ids(self._in_symbols(words[w])))[0])
                for w in np.flatnonzero(failed & (lengths > BESIDE))
            ]
            owner, ids = _joined(*map(np.concatenate, zip(*exact, strict=True)), alone)
        return np.bincount(owner, minlength=len(words)), ids

    def _in_symbols(self, word):
        return "".join([self.symbols[b] for b in word])

    def _split(self, chunk):
        """The words of a chunk as bytes; a special token's id stands for itself."""
        out = []
        for part in self.special.split(chunk) if "<|" in chunk else (chunk,):
            if part in self.added:
                out.append(self.added[part])
            elif self._knows(part):
                out += self._split_joined(part)
            else:
                out += self._library_words(part)
        return out

    def _split_joined(self, text):
        """The words of lower-cased text, and BLANK for each blank."""
        text = unicodedata.normalize("NFC", text).replace("Σ", "σ").lower()
        return [word.encode("utf-8") for word in self.pattern.findall(text)]

    def _knows(self, text):
        """Whether this Python knows all code points of ``text``."""
        if self.known.issuperset(text):
            return True
        self.known.update(c for c in set(text) if unicodedata.category(c) != "Cn")
        return self.known.issuperset(text)

    def _split_all(self, chunks):
        """(chunks in another order, their words with BLANK after each chunk)."""
        odd = [c for c in chunks if "<|" in c]
        plain = [c for c in chunks if c.isascii() and "<|" not in c]
        other = [c for c in chunks if not c.isascii() and "<|" not in c]
        if not self._knows("".join(other)):
            odd += [c for c in other if not self._knows(c)]
            other = [c for c in other if self._knows(c)]
        # Words do not reach over blanks, nor does what changes the letters.
        words = self.plain.findall(" ".join([*plain, ""]).lower().encode("ascii"))
        words += self._split_joined(" ".join([*other, ""]))
        for c in odd:
            words += self._split(c)
            words.append(BLANK)
        return [*plain, *other, *odd], words

    def _library_words(self, text):
        """Words of text with code points unknown here; the library may know later Unicode."""
        if self.library is None:
            self.library = Tokenizer.from_file(self.path)
        normal = self.library.normalizer.normalize_str(text)
        words = self.library.pre_tokenizer.pre_tokenize_str(normal)
        byte = {c: b for b, c in enumerate(self.symbols)}
        return [bytes(map(byte.__getitem__, w)) for w, _ in words]

    def _remember(self, chunks):
        """Has the ids of every chunk of the distinct ``chunks``, as int32 bytes, in ``self.now``."""
        if len(self.now) > REMEMBERED:
            self.now, self.last = {}, self.now
        missing = [c for c in chunks if c not in self.now]
        known = list(map(self.last.get, missing))
        self.now.update((c, k) for c, k in zip(missing, known, strict=True) if k is not None)
        missing = [c for c, k in zip(missing, known, strict=True) if k is None]
        if not missing:
            return
        missing, split = self._split_all(missing)
        whole = dict.fromkeys(split)
        words = [w for w in whole if type(w) is bytes and w != BLANK]
        specials = [w for w in whole if type(w) is int]
        sizes, ids = self._words(words) if words else (np.zeros(0, np.int64), np.zeros(0, np.int64))
        sizes = np.concatenate([sizes, np.ones(len(specials), np.int64), [0]])
        ids = np.concatenate([ids, np.array(specials, dtype=np.int64)]).astype("<i4")
        number = {w: i for i, w in enumerate([*words, *specials, BLANK])}
        order = np.fromiter(map(number.__getitem__, split), dtype=np.int64, count=len(split))
        made, ends = gathered(ids, sizes, order)
        ends = (ends[order == number[BLANK]] * 4).tolist()
        made = made.tobytes()
        self.now.update(
            zip(missing, [made[a:b] for a, b in zip([0, *ends], ends, strict=False)], strict=True)
        )

    def encode_all(self, texts):
        """(offsets, ids) of an Arrow array of texts: where each one's ids begin and the last end."""
        # A line feed is a blank to the tokenizer as well.
        chunks = pc.split_pattern(pc.replace_substring(texts, "\n", " "), " ")
        numbered = chunks.flatten().dictionary_encode()
        distinct = numbered.dictionary.to_numpy(zero_copy_only=False).tolist()
        self._remember(distinct)
        made = list(map(self.now.__getitem__, distinct))
        sizes = np.fromiter(map(len, made), dtype=np.int64, count=len(made)) // 4
        ids, ends = gathered(
            np.frombuffer(b"".join(made), dtype="<i4"), sizes, numbered.indices.to_numpy()
        )
        borders = np.concatenate([[0], ends])
        return borders[chunks.offsets.to_numpy() - chunks.offsets[0].as_py()], ids

    def encode(self, texts):
        """The ids of each text as int32 bytes."""
        offsets, ids = self.encode_all(pa.array(texts, pa.string()))
        return [ids[a:b].tobytes() for a, b in zip(offsets, offsets[1:], strict=False)]

    def decode_all(self, offsets, ids):
        """An Arrow array of :meth:`decode` of many texts' ids."""
        tokens = self.spelt.take(pa.array(ids))
        return pc.binary_join(pa.ListArray.from_arrays(pa.array(offsets), tokens), " ")

    def decode(self, ids):
        """The tokens, one blank between two, as the tokenizer has no decoder of its own."""
        return " ".join(map(self.tokens.__getitem__, ids))


def _joined(owner, ids, more):
    """(owner, ids) in the order of owners, with those of ``more``, lists of ids by owner."""
    owner = np.concatenate([owner, *(np.full(len(some), w) for w, some in more)])
    ids = np.concatenate([ids, *(np.array(some, dtype=np.int64) for _, some in more)])
    order = np.argsort(owner, kind="stable")
    return owner[order], ids[order]


@lru_cache(maxsize=2)
def tokenizer(path):
    return WordBpe(path)


def encode_decode(docs, path):
    """(doc_id, ids, decoded) per row of ``docs``: token ids and the text made of them.

    ``path`` is the tokenizer file, on every executor. A null text is an empty one, with no
    ids and the empty string; a null doc_id is kept; repeated rows are encoded alike; an
    empty table gives no rows. Only ``doc_id`` and ``text`` are read.
    """

    def each(batches):
        bpe = tokenizer(path)
        for batch in batches:
            texts = batch.column(1)
            for start, end in runs(pc.binary_length(texts).to_pylist(), SLICE_BYTES):
                offsets, flat = bpe.encode_all(texts.slice(start, end - start))
                offsets = offsets.astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(start, end - start),
                        pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat)),
                        bpe.decode_all(offsets, flat),
                    ],
                    ["doc_id", "ids", "decoded"],
                )

    rows = docs.select(F.col("doc_id").cast("long"), text_of().alias("text"))
    return map_in_arrow(rows, each, "doc_id long, ids array<int>, decoded string")


def digest(encoded):
    """Per row of :func:`encode_decode`: n_tokens, and SHA-256 of the ids and of the text."""
    return encoded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )
