"""Byte-pair encoding by speculation and verification, and decoding.

Text is cut into words by the vocabulary's pattern. For words not met before, a greedy longest
match proposes tokens. A proposal is the byte-pair encoding exactly if every adjacent pair of
its tokens stays apart when the two are encoded together; that is tested for all pairs of a batch at
once, by unwinding the merges along each seam in whole-array steps. Only words with a failing pair, or
with bytes that the vocabulary lacks, go through exact merging.
"""

from __future__ import annotations

import json
import re
from array import array
from collections.abc import Iterator
from functools import lru_cache
from heapq import heapify, heappop, heappush
from itertools import chain, islice

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from .common import list_array, slices, texts, tidy

# Split pattern of byte-level vocabularies, a fixed value.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
# Words kept with their tokens by each worker; beyond it only those just met stay.
MEMORY_WORDS = 1 << 19
# Words that a worker keeps from task to task.
KEPT_WORDS = 1 << 17
# Longer words are merged one by one, with a heap.
SHORT_BYTES = 64
_NEVER = np.int64(1) << 40
_LETTER, _NUMBER, _SPACE, _OTHER, _END = range(5)
# Texts of more characters together are cut one by one, which takes less memory.
_WHOLE_CHARS = 1 << 22
_SPREAD = np.uint64(0x9E3779B97F4A7C15)


def byte_letters() -> dict[str, int]:
    """The letters that byte-level vocabularies write for bytes: printable bytes stand for themselves,
    the others take the code points from 256 on, in order."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(rest)}


def splitter() -> re.Pattern:
    """The pattern for text without characters beyond U+FFFF, with its classes written out as ranges."""
    plane = "".join(chr(c) if not 0xD800 <= c < 0xE000 else "\0" for c in range(0x10000))

    def ranges(kind: str) -> str:
        runs = [m.span() for m in regex.compile(kind + "+").finditer(plane)]
        return "".join(f"\\u{a:04x}-\\u{z - 1:04x}" for a, z in runs)

    letters, numbers, spaces = ranges(r"\p{L}"), ranges(r"\p{N}"), ranges(r"\s")
    pattern = PATTERN.replace(r"[^\s\p{L}\p{N}]", f"[^{spaces}{letters}{numbers}]")
    for name, members in ((r"\p{L}", letters), (r"\p{N}", numbers), (r"\s", spaces)):
        pattern = pattern.replace(name, f"[{members}]")
    return re.compile(pattern.replace(r"(?!\S)", f"(?![^{spaces}])"))


@lru_cache(maxsize=1)
def kinds() -> np.ndarray:
    """For every code point whether the pattern counts it as a letter, a number, a space or none of them."""
    plane = "".join(chr(c) if not 0xD800 <= c < 0xE000 else "\0" for c in range(0x110000))
    out = np.full(len(plane), _OTHER, np.uint8)
    for kind, name in ((_LETTER, r"\p{L}"), (_NUMBER, r"\p{N}"), (_SPACE, r"\s")):
        for m in regex.compile(name + "+").finditer(plane):
            out[m.start() : m.end()] = kind
    return out


def word_starts(codes: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Where the pattern's words start in the code points of texts, each of which has one code point behind it, at ``ends``, as a word of its own."""
    kind = kinds()[codes]
    kind[ends] = _END
    start = np.r_[True, kind[1:] != kind[:-1]]
    start[ends] = True
    start[ends[:-1] + 1] = True
    # The last space before something else parts from the others; a blank goes with what follows.
    last = np.flatnonzero((kind[:-1] == _SPACE) & (kind[1:] != _SPACE) & (kind[1:] != _END))
    start[last] = True
    start[last[codes[last] == 32] + 1] = False
    # 's 't 'm 'd 're 've 'll, where a word starts with the apostrophe and a letter follows it
    at = np.flatnonzero(codes[:-1] == 39)
    at = at[start[at] & (kind[at + 1] == _LETTER)]
    one, two = codes[at + 1], codes[at + 2]
    pair = (((one == ord("r")) | (one == ord("v"))) & (two == ord("e"))) | ((one == ord("l")) & (two == ord("l")))
    size = np.where(np.isin(one, [ord(c) for c in "stmd"]), 1, np.where(pair, 2, 0))
    at, size = at[size > 0], size[size > 0]
    start[at + 1] = False
    behind = at + 1 + size
    start[behind[kind[behind] == _LETTER]] = True
    return np.flatnonzero(start)


def numbered(code: np.ndarray) -> np.ndarray:
    """The first place of each number, of numbers that are given in the order of their first places."""
    return np.flatnonzero(np.r_[True, code[1:] > np.maximum.accumulate(code)[:-1]][: len(code)])


class Table:
    """Numbers looked up by whole arrays of keys: a hash table in which the next free place is taken."""

    def __init__(self, keys: np.ndarray, values: np.ndarray):
        bits = max(4, int(4 * len(keys)).bit_length())
        self.shift, self.last = np.uint64(64 - bits), (1 << bits) - 1
        self.keys, self.values = np.full(1 << bits, -1, np.int64), np.full(1 << bits, -1, np.int64)
        place, left = self.place(keys), np.arange(len(keys))
        while len(left):
            free = left[self.keys[place[left]] < 0]
            self.keys[place[free]] = keys[free]  # of several keys one stays
            left = left[self.keys[place[left]] != keys[left]]
            place[left] = (place[left] + 1) & self.last
        self.values[place] = values

    def place(self, keys: np.ndarray) -> np.ndarray:
        with np.errstate(over="ignore"):
            return ((keys.astype(np.uint64) * _SPREAD) >> self.shift).astype(np.int64)

    def get(self, keys: np.ndarray) -> np.ndarray:
        """The values, -1 for keys that the table lacks. Keys are 0 or more."""
        at = self.place(keys)
        held = self.keys[at]
        out = np.where(held == keys, self.values[at], -1)
        left = np.flatnonzero((held != keys) & (held >= 0))
        while len(left):
            at[left] = (at[left] + 1) & self.last
            held = self.keys[at[left]]
            hit = held == keys[left]
            out[left[hit]] = self.values[at[left[hit]]]
            left = left[~hit & (held >= 0)]
        return out


class Vocabulary:
    """Tokens and merges of a byte-level BPE file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        letters = byte_letters()
        plain = {t: bytes(letters[c] for c in t) for t in spec["model"]["vocab"] if all(c in letters for c in t)}
        special = {a["content"]: a["id"] for a in spec.get("added_tokens", [])}
        self.bytes_of: dict[int, bytes] = {spec["model"]["vocab"][t]: b for t, b in plain.items()}
        self.bytes_of |= {i: t.encode() for t, i in special.items()}
        self.special = special
        self.id_of = {b: i for t, b in plain.items() if t not in special for i in (spec["model"]["vocab"][t],)}
        merges = [m.split(" ") if isinstance(m, str) else m for m in spec["model"]["merges"]]
        ids = spec["model"]["vocab"]
        self.ranks: dict[tuple[int, int], tuple[int, int]] = {}
        size = max(self.bytes_of) + 1
        # What a token was merged from and when; single bytes were never merged.
        self.left = np.full(size, -1, np.int64)
        self.right = np.full(size, -1, np.int64)
        self.rank = np.full(size, -1, np.int64)
        for r, (a, b) in enumerate(merges):
            x, y, z = ids[a], ids[b], ids[a + b]
            self.ranks.setdefault((x, y), (r, z))
            if self.rank[z] < 0:
                self.left[z], self.right[z], self.rank[z] = x, y, r
        self.size = size
        # Pair of tokens -> its place in the rows of ranks and results; the last place is that of all other pairs.
        keys = np.array([x * size + y for x, y in self.ranks], dtype=np.int64)
        self.pairs = Table(keys, np.arange(len(keys)))
        self.pair_ranks = np.array([*(r for r, _ in self.ranks.values()), _NEVER], dtype=np.int64)
        self.pair_ids = np.array([*(z for _, z in self.ranks.values()), -1], dtype=np.int64)
        self.byte_ids = [self.id_of.get(bytes([b])) for b in range(256)]
        self.byte_table = np.array([-1 if i is None else i for i in self.byte_ids], dtype=np.int64)
        self.sound = self._sound()
        self._tree()
        # The longest token with given first three bytes; where there is none, tokens have two bytes at most.
        self.reach: dict[bytes, int] = {}
        for token in self.sound:
            if len(token) > 2:
                self.reach[token[:3]] = max(len(token), self.reach.get(token[:3], 0))
        self.split, self.split_any, self.beyond = splitter(), regex.compile(PATTERN), re.compile("[\U00010000-\U0010ffff]")
        self.cut = regex.compile("|".join(map(regex.escape, sorted(special, key=len, reverse=True)))) if special else None
        self.named = {t: np.int32(i).tobytes() for t, i in special.items()}
        self.words: dict[str, bytes] = {}

    def _sound(self) -> dict[bytes, int]:
        """Tokens that the merges themselves yield from their own bytes; only those may be proposed.

        A merged token is sound if both halves are, were there before, and do not meet otherwise before its own merge.
        """
        made = np.flatnonzero(self.rank >= 0)
        made = made[np.argsort(self.rank[made], kind="stable")]
        x, y, r = self.left[made], self.right[made], self.rank[made]
        fits = (self.rank[x] < r) & (self.rank[y] < r) & self.apart(x, y, r)
        sound = {i for i in self.byte_ids if i is not None}
        for z, a, b, ok in zip(made.tolist(), x.tolist(), y.tolist(), fits.tolist()):
            if ok and a in sound and b in sound:
                sound.add(z)
        return {b: i for b, i in self.id_of.items() if i in sound}

    def exact(self, word: bytes) -> list[int]:
        """Plain merging of one word of any length: the lowest-ranked adjacent pair first, the leftmost of equals.

        Bytes without a token are left out, as no unknown token is defined.
        """
        parts = [i for i in map(self.byte_ids.__getitem__, word) if i is not None]
        after, before = [*range(1, len(parts)), -1], [*range(-1, len(parts) - 1)]
        ranks = self.ranks
        heap = [(ranks[p][0], k, p) for k, p in enumerate(zip(parts, parts[1:])) if p in ranks]
        heapify(heap)
        while heap:
            _, k, (x, y) = heappop(heap)
            n = after[k]
            if n < 0 or parts[k] != x or parts[n] != y:
                continue
            parts[k], parts[n] = ranks[x, y][1], -1
            after[k] = m = after[n]
            if m >= 0:
                before[m] = k
            for i, j in ((before[k], k), (k, m)):
                if i >= 0 and j >= 0 and (parts[i], parts[j]) in ranks:
                    heappush(heap, (ranks[parts[i], parts[j]][0], i, (parts[i], parts[j])))
        return [i for i in parts if i >= 0]

    def exact_batch(self, words: list[bytes]) -> list[bytes]:
        """``exact`` of many short words at once: in each round every word merges its lowest-ranked pairs.

        Returns the ids as little-endian 32-bit integers.
        """
        out = [b""] * len(words)
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        tok = self.byte_table[np.frombuffer(b"".join(words), np.uint8)]
        owner = np.repeat(np.arange(len(words)), sizes)[tok >= 0]
        tok = tok[tok >= 0]
        rank, merged = self.look(tok, owner, np.arange(len(tok)))
        while len(tok):
            starts = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]])
            lengths = np.diff(np.r_[starts, len(tok)])
            least = np.minimum.reduceat(rank, starts)
            done = least == _NEVER
            if done.any():
                raw = tok.astype("<i4").tobytes()
                for w, s, n in zip(owner[starts[done]].tolist(), starts[done].tolist(), lengths[done].tolist()):
                    out[w] = raw[4 * s : 4 * (s + n)]
                rest = np.repeat(~done, lengths)
                tok, owner, rank, merged = tok[rest], owner[rest], rank[rest], merged[rest]
                least, lengths = least[~done], lengths[~done]
                if not len(tok):
                    break
            hit = rank == np.repeat(least, lengths)
            # Equal pairs that overlap, as in "aaa": every other one of a row, from the left.
            at = np.arange(len(tok))
            chained = hit & np.r_[False, hit[:-1]]
            if chained.any():
                first = np.maximum.accumulate(np.where(hit & ~chained, at, 0))
                hit &= (at - first) % 2 == 0
            tok = np.where(hit, merged, tok)
            keep = ~np.r_[False, hit[:-1]]
            touched = np.cumsum(keep)[hit] - 1
            tok, owner, rank, merged = tok[keep], owner[keep], rank[keep], merged[keep]
            again = np.unique(np.r_[touched, touched[touched > 0] - 1])
            rank[again], merged[again] = self.look(tok, owner, again)
        return out

    def look(self, tok: np.ndarray, owner: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank and result of merging each token at ``at`` with the next of its word."""
        after = np.minimum(at + 1, max(len(tok) - 1, 0))
        place = self.pairs.get(tok[at] * self.size + tok[after])
        meets = (after > at) & (owner[after] == owner[at])
        return np.where(meets, self.pair_ranks[place], _NEVER), self.pair_ids[place]

    def propose(self, word: bytes) -> list[int] | None:
        """Greedy longest matches; None if some byte has no token."""
        out, at, end = [], 0, len(word)
        known, reach = self.sound, self.reach.get
        while at < end:
            for stop in range(min(end, at + reach(word[at : at + 3], 2)), at, -1):
                token = known.get(word[at:stop])
                if token is not None:
                    out.append(token)
                    at = stop
                    break
            else:
                return None
        return out

    def propose_batch(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """``propose`` of many words at once: (word, token) in the words' order, and which words have no proposal.

        All words walk down a tree of the tokens byte by byte; where a word can go no further, the longest token on its way
        is taken, and it starts again behind that.
        """
        data = np.frombuffer(b"".join(words) + b"\0", np.uint8)
        ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)))
        at = np.r_[0, ends[:-1]]
        live = np.flatnonzero(at < ends)
        node, token, taken = np.zeros(len(words), np.int64), np.full(len(words), -1, np.int64), at.copy()
        none = np.zeros(len(words), bool)
        found: list[tuple[np.ndarray, np.ndarray]] = []
        while len(live):
            here, inside = at[live], at[live] < ends[live]
            key = node[live] * 256 + data[np.where(inside, here, 0)]
            child = self.tree.get(key)
            goes = inside & (child >= 0)
            on, child = live[goes], child[goes]
            node[on] = child
            at[on] += 1
            ids = self.tree_token[child]
            whole = ids >= 0
            token[on[whole]], taken[on[whole]] = ids[whole], at[on[whole]]
            off = live[~goes]
            lost = token[off] < 0
            none[off[lost]] = True
            off = off[~lost]
            found.append((off, token[off]))
            at[off], node[off], token[off] = taken[off], 0, -1
            live = live[~none[live] & ((at[live] < ends[live]) | (token[live] >= 0) | (node[live] > 0))]
        owner, ids = (np.concatenate(x) for x in zip(*found)) if found else (np.zeros(0, np.int64),) * 2
        order = np.argsort(owner, kind="stable")
        return owner[order], ids[order], none

    def _tree(self) -> None:
        """The tokens as a tree: the node that (node, byte) leads to, and the token that ends at a node."""
        follow: dict[int, int] = {}
        ends = [-1]
        for word, i in self.sound.items():
            node = 0
            for byte in word:
                key = node * 256 + byte
                if key not in follow:
                    follow[key] = len(ends)
                    ends.append(-1)
                node = follow[key]
            ends[node] = i
        self.tree = Table(np.fromiter(follow, np.int64, len(follow)), np.fromiter(follow.values(), np.int64, len(follow)))
        self.tree_token = np.array(ends, np.int64)

    def merge_rank(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        """Rank at which the pairs merge; _NEVER if they do not."""
        return self.pair_ranks[self.pairs.get(x * self.size + y)]

    def apart(self, a: np.ndarray, b: np.ndarray, until: np.ndarray | None = None) -> np.ndarray:
        """Whether each pair of tokens stays two tokens when encoded together (by merges before ``until``).

        Backwards through the merges: at any moment the seam lies between the last piece ``x`` of the
        left token and the first piece ``y`` of the right one. The younger piece is undone first.
        ``until`` is the rank of the merge that next takes away a piece at the seam; if ``x`` and ``y``
        could merge before it, the seam would have closed. On equal ranks the leftmost merge comes first:
        the left token's piece then goes before the seam, and the seam before the right one's.
        """
        x, y = a.copy(), b.copy()
        until = np.full(len(a), _NEVER) if until is None else until.copy()
        good = np.ones(len(a), bool)
        live = np.arange(len(a))
        while len(live):
            u, v = x[live], y[live]
            closes = self.merge_rank(u, v) < until[live]
            good[live[closes]] = False
            ru, rv = self.rank[u], self.rank[v]
            whole = (ru < 0) & (rv < 0)
            go = ~closes & ~whole
            live, u, v, ru, rv = live[go], u[go], v[go], ru[go], rv[go]
            # Of two pieces made by the same merge the left one was made first, so the right one is undone first.
            first = ru > rv
            x[live[first]] = self.right[u[first]]
            until[live[first]] = ru[first]
            second = ~first
            y[live[second]] = self.left[v[second]]
            until[live[second]] = rv[second] + 1
        return good

    def stays(self, ids: np.ndarray, owner: np.ndarray) -> np.ndarray:
        """The owners of which some adjacent pair of tokens does not stay apart."""
        inside = np.flatnonzero(owner[1:] == owner[:-1])
        pairs, back = np.unique(ids[inside] * self.size + ids[inside + 1], return_inverse=True)
        return owner[inside[~self.apart(pairs // self.size, pairs % self.size)[back]]]

    def learn(self, words: list[str]) -> dict[str, bytes]:
        """Token ids of the words, as little-endian 32-bit integers."""
        raw = [w.encode("utf-8", "surrogatepass") for w in words]
        short = [i for i, w in enumerate(raw) if len(w) <= SHORT_BYTES]
        out: list[bytes] = [b""] * len(words)
        if len(short) < len(words):
            for i in set(range(len(words))).difference(short):
                ids = self.propose(raw[i])
                if ids is None or len(self.stays(np.array(ids, np.int64), np.zeros(len(ids), np.int64))):
                    ids = self.exact(raw[i])
                out[i] = array("i", ids).tobytes()
        few = [raw[i] for i in short]
        owner, ids, wrong = self.propose_batch(few)
        wrong[self.stays(ids, owner)] = True
        flat, cuts = ids.astype("<i4").tobytes(), np.searchsorted(owner, np.arange(len(few) + 1)) * 4
        for i, bad, a, z in zip(short, wrong.tolist(), cuts[:-1].tolist(), cuts[1:].tolist()):
            if not bad:
                out[i] = flat[a:z]
        again = np.flatnonzero(wrong).tolist()
        for k, found in zip(again, self.exact_batch([few[k] for k in again])):
            out[short[k]] = found
        return dict(zip(words, out))

    def cut_up(self, text: str) -> list[str]:
        """Words and special tokens of a text, in order."""
        find = self.split_any.findall if self.beyond.search(text) else self.split.findall
        if self.cut is None or not self.cut.search(text):
            return find(text)
        words, at = [], 0
        for m in self.cut.finditer(text):
            words += [*find(text[at : m.start()]), m.group()]
            at = m.end()
        return words + find(text[at:])

    def cut_all(self, batch: list[str]) -> tuple[np.ndarray, list[str], np.ndarray]:
        """Words of the texts in a row as places in the list of distinct words, that list, and where each text begins in the row, with its end."""
        joined = "\0".join([*batch, ""])
        try:
            data = joined.encode()
        except UnicodeEncodeError:  # lone surrogates, which Arrow does not hold
            data = None
        if data is None or not batch or len(joined) > _WHOLE_CHARS or (self.cut is not None and self.cut.search(joined)):
            cut, places = [self.cut_up(text) for text in batch], {}
            code = np.array([places.setdefault(w, len(places)) for w in chain.from_iterable(cut)], np.int64)
            return code, list(places), np.r_[0, np.cumsum([len(words) for words in cut], dtype=np.int64)]
        codes = np.frombuffer(joined.encode("utf-32-le"), "<u4")
        ends = np.cumsum(np.fromiter(map(len, batch), np.int64, len(batch)) + 1) - 1
        starts = word_starts(codes, ends)
        if len(data) == len(joined):
            places = starts
        else:
            sizes = np.cumsum(1 + (codes > 0x7F).astype(np.int8) + (codes > 0x7FF) + (codes > 0xFFFF), dtype=np.int64)
            places = np.r_[0, sizes][starts]
        offsets = np.r_[places, len(data)].astype(np.int64)
        words = pa.LargeStringArray.from_buffers(len(starts), pa.py_buffer(offsets), pa.py_buffer(data))
        code = words.dictionary_encode().indices.to_numpy()
        first = numbered(code)
        met = [joined[a:z] for a, z in zip(starts[first].tolist(), np.r_[starts[1:], len(joined)][first].tolist())]
        # The characters behind the texts go.
        behind = np.searchsorted(starts, ends)
        return np.delete(code, behind), met, np.r_[0, behind - np.arange(len(batch))]

    def encode(self, batch: list[str]) -> list[bytes]:
        """Token ids of each text, as little-endian 32-bit integers."""
        flat, cuts = self.encode_flat(batch)
        raw, at = flat.astype("<i4").tobytes(), (cuts * 4).tolist()
        return [raw[a:z] for a, z in zip(at, at[1:])]

    def encode_flat(self, batch: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Token ids of all texts in a row, and where each text begins in it, with the end behind the last."""
        code, met, cuts = self.cut_all(batch)
        # Each distinct word is looked up once; its ids are then laid out wherever it stands.
        ids = list(map(self.words.get, met))
        lost = [k for k, x in enumerate(ids) if x is None]
        new = self.learn([met[k] for k in lost if met[k] not in self.named])
        for k in lost:
            ids[k] = new.get(met[k]) if met[k] not in self.named else self.named[met[k]]
        if len(self.words) + len(new) > MEMORY_WORDS:
            self.words = dict(zip(met, ids))
        else:
            self.words |= new
        sizes = np.fromiter(map(len, ids), np.int64, len(ids)) // 4
        found = np.frombuffer(b"".join(ids), "<i4")
        first, lengths = (np.cumsum(sizes) - sizes)[code], sizes[code]
        ends = np.r_[0, np.cumsum(lengths)]
        flat = found[np.repeat(first - ends[:-1], lengths) + np.arange(ends[-1])]
        return flat, ends[cuts]

    def forget(self) -> None:
        """Let go of most words: a worker waits for its next task with those it met first, as frequent words are."""
        self.words = dict(islice(self.words.items(), KEPT_WORDS))

    def decode(self, ids) -> str:
        """Text of the ids, special tokens included; broken UTF-8 becomes U+FFFD, unknown ids nothing."""
        table = self.bytes_of
        return b"".join([table.get(i, b"") for i in ids]).decode("utf-8", "replace")


@lru_cache(maxsize=2)
def vocabulary(path: str) -> Vocabulary:
    """The vocabulary file at ``path``, once per worker. The file lies at the same path on every machine."""
    return Vocabulary(path)


def _with(df: DataFrame, column: str, kind: T.DataType) -> tuple[T.StructType, list[str]]:
    kept = [f for f in df.schema.fields if f.name != column]
    return T.StructType([*kept, T.StructField(column, kind)]), [f.name for f in kept]


def encode(df: DataFrame, path: str, text: str = "text", out: str = "ids", keep_text: bool = False) -> DataFrame:
    """``df`` with the token ids of ``text`` as array<int>; the text column goes unless ``keep_text``.

    Null and empty texts give no ids. A column called ``out`` is replaced.
    """
    source = df if out == text else df.drop(out)
    if not keep_text:
        schema, kept = _with(source.drop(text), out, T.ArrayType(T.IntegerType()))
    else:
        schema, kept = _with(source, out, T.ArrayType(T.IntegerType()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v = vocabulary(path)
        for batch in slices(batches, text):
            flat, offsets = v.encode_flat(texts(batch.column(text)))
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in kept], list_array(flat, offsets)], [*kept, out])
        v.forget()

    return source.mapInArrow(tidy(run), schema)


def decode(df: DataFrame, path: str, ids: str = "ids", out: str = "decoded") -> DataFrame:
    """``df`` with the text of the token ids; null ids give an empty text. A column called ``out`` is replaced."""
    source = df if out == ids else df.drop(out)
    schema, kept = _with(source, out, T.StringType())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v = vocabulary(path)
        for part in slices(batches, ids):
            text = [v.decode(x or ()) for x in part.column(ids).to_pylist()]
            yield pa.RecordBatch.from_arrays([*[part.column(c) for c in kept], pa.array(text, pa.string())], [*kept, out])

    return source.mapInArrow(tidy(run), schema)
