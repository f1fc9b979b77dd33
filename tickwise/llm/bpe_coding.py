"""Byte-level BPE encoding and decoding by dynamic programming over prefixes.

The encodings of all prefixes of a word fit together: if the encoding of a
prefix ends with token t, what stands before t is the encoding of the shorter
prefix, and of all tokens that end at a place exactly one is compatible with
the last token of the prefix before it.  So one pass over a word stores the
last token of every prefix: an automaton with suffix links gives the tokens
that end at each place, longest first, a test of the token pair keeps the one
that merging would leave there, and the back-pointers (place minus the token's
length) are followed from the end of the word to emit the ids.  No merge queue
is run; a word of any length takes time in proportion to its length.

Two tokens are compatible if merging their joined text leaves exactly these
two: the later of the two merges is undone again and again, and at no time may
the two tokens at the seam form a pair that would have been merged earlier.

Words are what the tokenizer file's own pre-tokenisation gives (byte level,
its fixed pattern), after the strings of its added tokens are cut out.

Defined results: null text counts as empty (no ids, decoded to an empty text);
very long texts and words are encoded whole; ids that spell no valid UTF-8
decode with U+FFFD in place of each invalid part, as the tokenizer's own
decoder does; repeated rows give repeated result rows; an empty table gives no
row; only ``doc_id`` and ``text`` are read, so other columns may have any name.
Every prefix has one last token, so there are no ties.
"""

from __future__ import annotations

import json
import re
import unicodedata

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import on_workers

CACHE_WORDS = 150_000     # words whose ids a worker remembers (memory bound, no effect on results)
CACHE_PAIRS = 500_000     # token pairs whose test is remembered within a long word (likewise)
LONG_WORD = 64            # bytes above which a word is encoded alone (likewise)
LEARN_WORDS = 20_000      # shorter words encoded together at most (likewise)
PART_BYTES = 1_000_000    # characters of text, or bytes of ids, worked on together

#: Up to here the classes of letters, numbers and spaces are the same in every Unicode version;
#: texts with later characters are cut by the library's pre-tokeniser.
STABLE = 0x24F


def default_tokenizer() -> str:
    import public_tokenizers
    return public_tokenizers.path("byte_bpe_50k.json")


def byte_letters() -> list[str]:
    """The letter that stands for each byte in a byte-level vocabulary: the
    printable ones for themselves, the others from U+0100 on."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in shown]
    letters = {b: chr(b) for b in shown} | {b: chr(256 + k) for k, b in enumerate(hidden)}
    return [letters[b] for b in range(256)]


def word_pattern() -> re.Pattern:
    """The fixed pattern of byte-level pre-tokenisation, its character classes
    spelt out up to ``STABLE``."""
    chars = [chr(c) for c in range(STABLE + 1)]
    letters = "".join(re.escape(c) for c in chars if unicodedata.category(c).startswith("L"))
    numbers = "".join(re.escape(c) for c in chars if unicodedata.category(c).startswith("N"))
    spaces = r"\t\n\x0b\x0c\r \x85\xa0"
    return re.compile(f"'s|'t|'re|'ve|'m|'ll|'d| ?[{letters}]+| ?[{numbers}]+| ?[^{spaces}{letters}{numbers}]+"
                      f"|[{spaces}]+(?![^{spaces}])|[{spaces}]+")


class Vocabulary:
    """Tokens, merges and added tokens of a byte-level BPE tokenizer file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model, pre = spec["model"], spec.get("pre_tokenizer") or {}
        added = spec.get("added_tokens") or []
        plain = (model["type"] == "BPE" and not spec.get("normalizer") and not spec.get("post_processor")
                 and pre.get("type") == "ByteLevel" and pre.get("use_regex", True)
                 and not pre.get("add_prefix_space") and not model.get("dropout")
                 and not model.get("ignore_merges") and not model.get("end_of_word_suffix")
                 and not any(t["single_word"] or t["lstrip"] or t["rstrip"] or t["normalized"] for t in added))
        if not plain:
            raise ValueError("not a plain byte-level BPE tokenizer file")
        byte_of = {c: b for b, c in enumerate(byte_letters())}
        self.bytes_of = {i: bytes(byte_of[c] for c in t) for t, i in model["vocab"].items()}
        self.added = {t["content"]: t["id"] for t in added}
        self.bytes_of.update((i, t.encode()) for t, i in self.added.items())
        merges = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        vocab = model["vocab"]
        self.rank: dict[int, int] = {}                      # when a token is merged
        self.halves: dict[int, tuple[int, int]] = {}
        self.pair_rank: dict[tuple[int, int], int] = {}
        for r, (a, b) in enumerate(merges):
            pair, whole = (vocab[a], vocab[b]), vocab[a + b]
            self.pair_rank.setdefault(pair, r)
            if whole not in self.rank:
                self.rank[whole], self.halves[whole] = r, pair
        for whole, (a, b) in self.halves.items():
            if max(self.rank.get(a, -1), self.rank.get(b, -1)) >= self.rank[whole]:
                raise ValueError("a merge comes before those of its parts")

    def compatible(self, a: int, b: int, before: int | None = None) -> bool:
        """Whether merging the joined text leaves just ``a`` and ``b`` (with
        ``before``: at the time of that merge)."""
        rank, pair_rank = self.rank, self.pair_rank
        before = len(self.pair_rank) + 1 if before is None else before
        while True:
            if pair_rank.get((a, b), before) < before:
                return False
            ra, rb = rank.get(a, -1), rank.get(b, -1)
            if ra > rb:
                before, a = ra, self.halves[a][1]
            elif rb < 0:
                return True
            else:        # the same merge further left comes first
                before, b = rb + 1, self.halves[b][0]

    def tokens(self) -> dict[bytes, int]:
        """Tokens that merging can leave: single bytes, and those whose own
        text is merged into them."""
        return {t: i for i, t in self.bytes_of.items() if i not in self.added.values() and (
            len(t) == 1 or i in self.halves and self.compatible(*self.halves[i], before=self.rank[i]))}


class PairTest:
    """:meth:`Vocabulary.compatible` for arrays of token pairs."""

    def __init__(self, v: Vocabulary):
        import numpy as np
        size = max(v.bytes_of) + 1
        self.rank = np.full(size, -1, np.int64)
        self.left, self.right = np.zeros(size, np.int64), np.zeros(size, np.int64)
        for token, r in v.rank.items():
            self.rank[token] = r
            self.left[token], self.right[token] = v.halves[token]
        pairs = sorted((a << 32 | b, r) for (a, b), r in v.pair_rank.items())
        self.keys = np.array([k for k, _ in pairs] + [1 << 62], np.int64)
        self.ranks = np.array([r for _, r in pairs] + [0], np.int64)

    def __call__(self, a, b):
        import numpy as np
        pairs, back = np.unique(a << 32 | b, return_inverse=True)
        a, b = pairs >> 32, pairs & 0xFFFFFFFF
        fits = np.zeros(len(pairs), bool)
        at, before = np.arange(len(pairs)), np.full(len(pairs), len(self.keys))
        while len(at):
            key = a << 32 | b
            k = np.searchsorted(self.keys, key)
            ra, rb = self.rank[a], self.rank[b]
            alive = (self.keys[k] != key) | (self.ranks[k] >= before)
            undo_left = ra > rb
            fits[at[alive & ~undo_left & (rb < 0)]] = True
            alive &= undo_left | (rb >= 0)
            before = np.where(undo_left, ra, rb + 1)[alive]
            a, b = np.where(undo_left, self.right[a], a)[alive], np.where(undo_left, b, self.left[b])[alive]
            at = at[alive]
        return fits[back]


class SuffixMatcher:
    """Automaton over bytes that knows at every place which tokens end there:
    ``longest`` of a state, then ``shorter`` of each token (-1: no more)."""

    def __init__(self, tokens: dict[bytes, int]):
        import numpy as np
        children: list[dict[int, int]] = [{}]
        token_at: list[int] = [-1]
        for t, i in tokens.items():
            node = 0
            for byte in t:
                if byte not in children[node]:
                    children[node][byte] = len(children)
                    children.append({})
                    token_at.append(-1)
                node = children[node][byte]
            token_at[node] = i
        self.next = np.zeros((len(children), 256), np.int32)
        self.longest = np.array(token_at, np.int64)
        self.shorter = np.full(max(tokens.values()) + 1, -1, np.int64)
        level = [(node, 0) for node in children[0].values()]
        for byte, node in children[0].items():
            self.next[0, byte] = node
        while level:
            below = []
            for node, link in level:       # link: the longest proper suffix that is a state
                self.next[node] = self.next[link]
                if token_at[node] >= 0:
                    self.shorter[token_at[node]] = self.longest[link]
                else:
                    self.longest[node] = self.longest[link]
                for byte, child in children[node].items():
                    below.append((child, int(self.next[link, byte])))
                    self.next[node, byte] = child
            level = below


class PrefixEncoder:
    """Ids of texts as little-endian uint32 bytes.  Unknown words of many texts
    are encoded together, place by place; words of more than ``LONG_WORD``
    bytes one by one."""

    def __init__(self, path: str):
        import numpy as np
        from tokenizers.pre_tokenizers import ByteLevel
        self.vocabulary = Vocabulary(path)
        self.ends = SuffixMatcher(self.vocabulary.tokens())
        self.fits = PairTest(self.vocabulary)
        self.lengths = np.zeros(max(self.vocabulary.bytes_of) + 1, np.int64)
        for i, t in self.vocabulary.bytes_of.items():
            self.lengths[i] = len(t)
        self.words = word_pattern()
        self.late = re.compile(f"[^\\x00-{chr(STABLE)}]")
        self.own = ByteLevel(add_prefix_space=False)
        added = sorted(self.vocabulary.added, key=len, reverse=True)
        self.cut = re.compile("(" + "|".join(map(re.escape, added)) + ")") if added else None
        self.seen: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    def split(self, text: str) -> list[str]:
        """The words of a text; its added tokens are words of their own."""
        if self.cut is not None and self.cut.search(text):
            parts = self.cut.split(text)
            return [w for k, part in enumerate(parts)
                    for w in ([part] if k % 2 else self.split_plain(part))]
        return self.split_plain(text)

    def split_plain(self, text: str) -> list[str]:
        if self.late.search(text):
            return [text[a:b] for _, (a, b) in self.own.pre_tokenize_str(text)]
        return self.words.findall(text)

    def __call__(self, texts: list[str]) -> list[bytes]:
        if len(self.seen) > CACHE_WORDS:
            self.older, self.seen = self.seen, {}
        words = [self.split(t) for t in texts]
        seen, older = self.seen, self.older
        new = set().union(*words).difference(seen)
        for w in [w for w in new if w in older]:
            seen[w] = older[w]
            new.discard(w)
        for w in new.intersection(self.vocabulary.added):
            seen[w] = self.vocabulary.added[w].to_bytes(4, "little")
            new.discard(w)
        self.learn(list(new))
        return [b"".join([seen[w] for w in ws]) for ws in words]

    def learn(self, words: list[str]) -> None:
        raw = sorted(((w.encode(), w) for w in words), key=lambda p: -len(p[0]))
        k = 0
        while k < len(raw) and len(raw[k][0]) > LONG_WORD:
            self.seen[raw[k][1]] = self.follow(self.last_tokens(raw[k][0]))
            k += 1
        for i in range(k, len(raw), LEARN_WORDS):
            part = raw[i:i + LEARN_WORDS]
            for (_, w), ids in zip(part, self.together([b for b, _ in part])):
                self.seen[w] = ids

    def last_tokens(self, word: bytes) -> list[int]:
        """The last token of every prefix of one word (the empty one: -1)."""
        last, state, tested = [-1], 0, {}
        following, longest, shorter, lengths = self.ends.next, self.ends.longest, self.ends.shorter, self.lengths
        for end, byte in enumerate(word, 1):
            state = following[state, byte]
            token = int(longest[state])
            while lengths[token] < end:
                pair = last[end - lengths[token]], token
                if pair not in tested:
                    if len(tested) > CACHE_PAIRS:
                        tested.clear()
                    tested[pair] = self.vocabulary.compatible(*pair)
                if tested[pair]:
                    break
                token = int(shorter[token])
            last.append(token)
        return last

    def follow(self, last: list[int]) -> bytes:
        at, out = len(last) - 1, []
        while at:
            out.append(last[at].to_bytes(4, "little"))
            at -= int(self.lengths[last[at]])
        return b"".join(reversed(out))

    def together(self, words: list[bytes]) -> list[bytes]:
        """Ids of words sorted by length, longest first: the same for all of
        them at each place."""
        import numpy as np
        n, sizes = len(words), np.array([len(w) for w in words])
        width = int(sizes[0])
        text = np.frombuffer(b"".join([w.ljust(width, b"\0") for w in words]), np.uint8).reshape(n, width)
        last = np.full((n, width + 1), -1, np.int64)
        state = np.zeros(n, np.int64)
        for end in range(1, width + 1):
            active = int(np.searchsorted(-sizes, -end, side="right"))
            state = self.ends.next[state[:active], text[:active, end - 1]]
            token = self.ends.longest[state]
            row = np.flatnonzero(self.lengths[token] < end)    # the others span the whole prefix
            while len(row):
                t = token[row]
                row = row[~self.fits(last[row, end - self.lengths[t]], t)]
                token[row] = self.ends.shorter[token[row]]
                row = row[self.lengths[token[row]] < end]
            last[:active, end] = token
        ids, at, row = np.empty((n, width), "<u4"), sizes.copy(), np.arange(n)
        count = np.zeros(n, np.int64)
        while len(row):
            token = last[row, at[row]]
            count[row] += 1
            ids[row, width - count[row]] = token
            at[row] -= self.lengths[token]
            row = row[at[row] > 0]
        return [ids[k, width - c:].tobytes() for k, c in enumerate(count.tolist())]


_ENCODERS: dict[str, PrefixEncoder] = {}
_BYTES: dict[str, dict[int, bytes]] = {}


def _encoder(path: str) -> PrefixEncoder:
    if path not in _ENCODERS:
        _ENCODERS[path] = PrefixEncoder(path)
    return _ENCODERS[path]


def _bytes_of(path: str) -> dict[int, bytes]:
    if path in _ENCODERS:
        return _ENCODERS[path].vocabulary.bytes_of
    if path not in _BYTES:
        _BYTES[path] = Vocabulary(path).bytes_of
    return _BYTES[path]


def decode(ids: bytes, bytes_of: dict[int, bytes]) -> str:
    """The text of little-endian uint32 ids; unknown ids stand for nothing."""
    from array import array
    import sys
    a = array("I")
    a.frombytes(ids)
    if sys.byteorder == "big":
        a.byteswap()
    try:
        text = b"".join([bytes_of[i] for i in a])
    except KeyError:
        text = b"".join([bytes_of.get(i, b"") for i in a])
    return text.decode("utf-8", "replace")


def _parts(batch):
    """Rows (id, value or None) of an Arrow batch, ``PART_BYTES`` at a time."""
    ids, values, size = [], [], 0
    for d, v in zip(batch.column(0), batch.column(1)):
        ids.append(d.as_py())
        values.append(v.as_py())
        size += len(values[-1] or "")
        if size > PART_BYTES:
            yield ids, values
            ids, values, size = [], [], 0
    if ids:
        yield ids, values


def bpe_encode(docs: DataFrame, tokenizer: str | None = None, decoded: bool = False) -> DataFrame:
    """(doc_id, ids) for every row; ids: little-endian uint32, in order.  With
    ``decoded`` also what :func:`bpe_decode` makes of the ids, in the same pass."""
    path = tokenizer or default_tokenizer()

    def run(batches):
        import pyarrow as pa
        encode = _encoder(path)
        for b in batches:
            for doc_ids, texts in _parts(b):
                ids = encode([t or "" for t in texts])
                columns = [pa.array(doc_ids, pa.int64()), pa.array(ids, pa.binary())]
                if decoded:
                    columns.append(pa.array([decode(i, _bytes_of(path)) for i in ids], pa.string()))
                yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "ids", "decoded"][:len(columns)])

    return on_workers(docs).select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(
        run, "doc_id long, ids binary" + (", decoded string" if decoded else ""))


def bpe_decode(encoded: DataFrame, tokenizer: str | None = None) -> DataFrame:
    """(doc_id, ids, decoded) for every row of (doc_id, ids); null ids: none."""
    path = tokenizer or default_tokenizer()

    def run(batches):
        import pyarrow as pa
        bytes_of = _bytes_of(path)
        for b in batches:
            for doc_ids, ids in _parts(b):
                ids = [i or b"" for i in ids]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(doc_ids, pa.int64()), pa.array(ids, pa.binary()),
                     pa.array([decode(i, bytes_of) for i in ids], pa.string())], names=["doc_id", "ids", "decoded"])

    return on_workers(encoded).select(F.col("doc_id").cast("long"), F.col("ids").cast("binary")).mapInArrow(
        run, "doc_id long, ids binary, decoded string")
