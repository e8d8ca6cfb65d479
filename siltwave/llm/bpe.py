"""Byte-pair encoding as a bounded-lookahead transducer, and decoding as a state machine.

``MergeTable`` reads a ``tokenizers`` JSON file. Its transducer reads one symbol at a time (``LockStep``: one symbol of
each of many pre-tokens) and keeps, for each of the last ``reach`` prefixes of the pre-token, the last token of that
prefix's encoding. Every prefix has exactly one such
token: the one among the vocabulary's suffixes that stays apart from the token before it (merging both together gives
the two back). A token is emitted as soon as the back-pointers of all prefixes that later symbols can still refer to
meet at or after its end; ``lookahead``, computed from the merge list, bounds how far that is.
"""

from __future__ import annotations

import codecs
import functools
import json
import re
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._common import pieces


@functools.cache
def byte_alphabet() -> list[str]:
    """The printable character that stands for each byte in byte-level vocabularies."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(shown)]
    return [chr(b) if b in set(shown) else chr(256 + rest.index(b)) for b in range(256)]


class MergeTable:
    """Vocabulary and merges of one tokenizer file, with the transducer over them."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        self.vocab: dict[str, int] = model["vocab"]
        self.suffix: str = model["end_of_word_suffix"] or ""
        merges = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in model["merges"]]
        self.ranks = {m: k for k, m in reversed(list(enumerate(merges)))}
        self.specials = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.strings = {i: s for s, i in (self.vocab | self.specials).items()}
        self.bytes_to_chars = {b: c for b, c in enumerate(byte_alphabet())}
        self.reach = max(map(self.length, self.vocab))
        self.lookahead = self._lookahead(merges)
        self._apart: dict[tuple[str, str], bool] = {}
        self.made_of = {a + b: (a, b) for a, b in reversed(merges)}
        self.proved = self._prove()
        self.complete = all(c + m in self.proved for c in byte_alphabet() for m in {"", self.suffix})

    def length(self, token: str) -> int:
        """Symbols in a token; the end-of-word mark belongs to the symbol before it."""
        return len(token) - (len(self.suffix) if self.suffix and token.endswith(self.suffix) else 0)

    def _lookahead(self, merges: list[tuple[str, str]]) -> int:
        """How many symbols past a token can still change it.

        A merge (b, c) takes b away from a later merge (a, b), which sets a free for a still later (z, a), and so on
        to the left. The longest such chain of rising ranks, in symbols, plus the longest token bounds the effect.
        """
        best: dict[str, int] = {}
        most = 0
        for left, right in reversed(merges):
            chain = self.length(left) + best.get(left, 0)
            best[right] = max(best.get(right, 0), chain)
            most = max(most, chain)
        return most + self.reach

    def symbols(self, piece: str) -> list[str]:
        chars = self.bytes_to_chars
        out = [chars[b] for b in piece.encode("utf-8")]
        if out and self.suffix:
            out[-1] += self.suffix
        return out

    def merge(self, parts: list[str]) -> list[str]:
        """Apply the merges by rank, leftmost first; used on pairs of tokens and in proofs, so on short lists only."""
        parts = list(parts)
        while len(parts) > 1:
            rank, at = min((self.ranks.get(p, len(self.ranks)), i) for i, p in enumerate(zip(parts, parts[1:])))
            if rank == len(self.ranks):
                break
            parts[at : at + 2] = ["".join(parts[at : at + 2])]
        return parts

    def split(self, token: str) -> list[str]:
        cut = self.length(token)
        parts = list(token[:cut])
        if cut < len(token):
            parts[-1] += token[cut:]
        return parts

    def _prove(self) -> set[str]:
        """The vocabulary strings whose own symbols merge back to one token."""
        return {t for t in self.vocab if self.merge(self.split(t)) == [t]}

    def _spine(self, token: str, side: int) -> list[tuple[str, int]]:
        """The tokens at one edge of ``token`` as its merges are undone, each with the rank that made it (-1: a symbol)."""
        out = []
        while True:
            parts = self.made_of.get(token)
            out.append((token, self.ranks[parts] if parts else -1))
            if not parts:
                return out
            token = parts[side]

    def _apart_now(self, left: str, right: str) -> bool:
        """True where no merge ever crosses the border between the two tokens, as their own merges go on.

        Backwards in time: ``x`` and ``y`` face each other until the earlier of the two is used up by its own side.
        Of equal ranks the left one goes first.
        """
        xs, ys, i, j = self._spine(left, 1), self._spine(right, 0), 0, 0
        none = len(self.ranks)
        end_x = end_y = none
        while True:
            rank = self.ranks.get((xs[i][0], ys[j][0]), none)
            if rank < end_x and rank <= end_y and rank < none:
                return False
            made_x, made_y = xs[i][1], ys[j][1]
            if made_x < 0 and made_y < 0:
                return True
            if made_x > made_y:
                end_x, i = made_x, i + 1
            else:
                end_y, j = made_y, j + 1

    def apart(self, left: str, right: str) -> bool:
        """True where the two tokens, put side by side, encode as just these two."""
        known = self._apart.get((left, right))
        if known is None:
            if len(self._apart) > 200_000:
                self._apart.clear()
            known = self._apart[left, right] = self._apart_now(left, right)
        return known

    def stream(self, symbols: Iterable[str]) -> Iterator[str]:
        """Tokens of one pre-token, each given out once no later symbol can change it."""
        window: list[str] = []  # symbols not yet given out
        last: list = [("", 0)]  # for each prefix of the window: its last token and where that begins
        for symbol in symbols:
            window.append(symbol)
            n = len(window)
            found = None
            for start in range(max(0, n - self.reach), n):
                token = "".join(window[start:])
                if token in self.proved and last[start] is not None:
                    before = last[start][0]
                    if not before or self.apart(before, token):
                        found = (token, start)
                        break
            last.append(found)
            if n > 2 * self.lookahead and n % self.lookahead == 0:
                yield from self._settle(window, last)
        at, out = len(window), []
        while at > 0:
            token, at = last[at]
            out.append(token)
        yield from reversed(out)

    def _settle(self, window: list[str], last: list) -> Iterator[str]:
        """Give out the tokens on which all prefixes that can still be continued agree, and forget their symbols."""
        n = len(window)
        ends = {i for i in range(max(0, n - self.reach), n + 1) if last[i] is not None}
        while len(ends) > 1:
            far = max(ends)
            ends.discard(far)
            ends.add(last[far][1])
        meet, at, out = ends.pop(), 0, []
        if not meet:
            return
        at = meet
        while at > 0:
            token, at = last[at]
            out.append(token)
        yield from reversed(out)
        kept = last[meet][0]
        del window[:meet]
        last[:] = [(kept, 0)] + [x and (x[0], x[1] - meet) if x is None or x[1] >= meet else None for x in last[meet + 1 :]]

    def tokens(self, piece: str) -> list[str]:
        """Tokens of one pre-token, one symbol at a time; symbols outside the vocabulary give nothing."""
        parts: list[str] = []
        run: list[str] = []
        for s in self.symbols(piece):
            if s in self.vocab:
                run.append(s)
            else:
                parts += self.stream(run)
                run = []
        return parts + list(self.stream(run))

    def ids(self, piece: str) -> list[int]:
        return [self.vocab[t] for t in self.tokens(piece)]


class Lookup:
    """Whole numbers from 0 on to whole numbers, for many keys at once; -1 where a key isn't there."""

    def __init__(self, keys, values):
        keys, values = np.asarray(keys, np.int64), np.asarray(values, np.int64)
        bits = max(4, (4 * len(keys)).bit_length())
        self.shift, self.mask = np.uint64(64 - bits), (1 << bits) - 1
        self.keys, self.values = np.full(1 << bits, -1, np.int64), np.full(1 << bits, -1, np.int32)
        slot = self.slots(keys)
        while len(keys):
            free = self.keys[slot] < 0
            self.keys[slot[free]] = keys[free]  # of several keys for one slot the last stays
            own = self.keys[slot] == keys
            self.values[slot[own]] = values[own]
            keys, values, slot = keys[~own], values[~own], (slot[~own] + 1) & self.mask

    def slots(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> self.shift).astype(np.int64)

    def get(self, keys: np.ndarray) -> np.ndarray:
        slot = self.slots(keys)
        there = self.keys[slot]
        out = self.values[slot]
        out[there != keys] = -1
        at = np.flatnonzero((there != keys) & (there >= 0))
        while len(at):
            slot = (slot[at] if len(slot) == len(keys) else slot) + 1 & self.mask
            there, want = self.keys[slot], keys[at]
            hit = there == want
            out[at[hit]] = self.values[slot[hit]]
            on = ~hit & (there >= 0)
            at, slot = at[on], slot[on]
        return out


class LockStep:
    """The transducer of a ``MergeTable`` over many pre-tokens at once: each step reads one more byte of all of them.

    A trie over the vocabulary strings that are proved to encode alone finds the tokens that end at a byte; of these
    the one that stays apart from the last token of the prefix before it becomes that prefix's last token. Whether two
    tokens stay apart is worked out once and held in a table of fixed size. Pre-tokens longer than four times
    the lookahead go through ``MergeTable.stream``, in constant memory.
    """

    CELLS, PAIRS = 1 << 20, 19

    def __init__(self, table: MergeTable):
        self.table, self.width = table, max(table.vocab.values()) + 1
        back = {c: b for b, c in enumerate(byte_alphabet())}
        step: dict[int, int] = {}
        token_of = [-1]
        for token in table.proved:
            cut, node = table.length(token), 0
            for key in [back[c] for c in token[:cut]] + [256] * (cut < len(token)):
                key += node * 257
                node = step.get(key)
                if node is None:
                    node = step[key] = len(token_of)
                    token_of.append(-1)
            token_of[node] = table.vocab[token]
        self.step = Lookup(list(step), list(step.values()))
        self.token_of = np.asarray(token_of, np.int32)
        self.ranks = Lookup([table.vocab[a] * self.width + table.vocab[b] for a, b in table.ranks], list(table.ranks.values()))
        self.made, self.left, self.right = (np.full(self.width, -1, np.int32) for _ in range(3))
        for token, (a, b) in table.made_of.items():
            self.made[table.vocab[token]], self.left[table.vocab[token]], self.right[table.vocab[token]] = table.ranks[a, b], table.vocab[a], table.vocab[b]
        self.pairs, self.answers = np.full(1 << self.PAIRS, -1, np.int64), np.zeros(1 << self.PAIRS, bool)

    def _apart_now(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        """``MergeTable._apart_now`` for many pairs of token ids."""
        out, at, none = np.zeros(len(x), bool), np.arange(len(x)), len(self.table.ranks)
        end_x = np.full(len(x), none)
        end_y = end_x.copy()
        while len(at):
            rank = self.ranks.get(x * self.width + y)
            made_x, made_y = self.made[x], self.made[y]
            joined = (rank >= 0) & (rank < end_x) & (rank <= end_y)
            done = ~joined & (made_x < 0) & (made_y < 0)
            out[at[done]] = True
            on = ~joined & ~done
            at, x, y, end_x, end_y, made_x, made_y = (v[on] for v in (at, x, y, end_x, end_y, made_x, made_y))
            left = made_x > made_y
            end_x, end_y = np.where(left, made_x, end_x), np.where(left, end_y, made_y)
            x, y = np.where(left, self.right[x], x).astype(np.int64), np.where(left, y, self.left[y]).astype(np.int64)
        return out

    def apart(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        key = x.astype(np.int64) * self.width + y
        slot = ((key.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.PAIRS)).astype(np.int64)
        out, new = self.answers[slot], self.pairs[slot] != key
        if new.any():
            fresh, place = np.unique(key[new], return_inverse=True)
            found = self._apart_now(fresh // self.width, fresh % self.width)
            out[new] = found[place]
            # two keys may share a slot: the one written last stays, with its own answer
            order = slot[new]
            self.pairs[order] = key[new]
            own = self.pairs[order] == key[new]
            self.answers[order[own]] = out[new][own]
        return out

    def encode(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all pre-tokens, one after the other, and how many each has."""
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        order = np.argsort(-sizes, kind="stable")
        n_long = int((sizes > 4 * self.table.lookahead).sum()) if self.table.complete else len(words)
        counts = np.zeros(len(words), np.int64)
        found = []
        for k in order[:n_long].tolist():
            ids = np.asarray(self.table.ids(words[k].decode("utf-8")), np.int32)
            counts[k] = len(ids)
            found.append((np.asarray([k]), ids, np.asarray([0])))
        at = n_long
        while at < len(words):
            n = max(1, self.CELLS // (int(sizes[order[at]]) + 1))
            some = order[at : at + n]
            at += n
            ids, counts[some] = self._group([words[k] for k in some.tolist()], sizes[some])
            found.append((some, ids, np.concatenate([[0], np.cumsum(counts[some])[:-1]])))
        stops = np.cumsum(counts)
        out = np.empty(int(stops[-1]) if len(stops) else 0, np.int32)
        for some, ids, firsts in found:
            n = counts[some]
            out[np.repeat(stops[some] - n - firsts, n) + np.arange(len(ids))] = ids
        return out, counts

    def _group(self, words: list[bytes], sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Pre-tokens in falling order of length."""
        n, most = len(words), int(sizes[0]) if len(words) else 0
        flat = np.frombuffer(b"".join(words), np.uint8).astype(np.int64)
        begin = np.cumsum(sizes) - sizes
        last = np.full((most + 1, n), -1, np.int32)  # for each prefix: its last token, and where that begins
        since = np.zeros((most + 1, n), np.int16)
        final, final_since = np.full(n, -1, np.int32), np.zeros(n, np.int16)
        reaching = np.searchsorted(-sizes, -np.arange(1, most + 2), side="right")  # how many have at least 1, 2, ... bytes
        marked = bool(self.table.suffix)
        word = start = node = np.zeros(0, np.int64)

        def choose(word, start, token):
            ok = start == 0
            rest = np.flatnonzero(~ok)
            ok[rest] = self.apart(last[start[rest], word[rest]], token[rest])
            keep = np.flatnonzero(ok)[::-1]  # the longest token is written last
            return word[keep], start[keep], token[keep]

        for end in range(1, most + 1):
            here = int(reaching[end - 1])
            on = word < here
            open_ = np.flatnonzero(last[end - 1, :here] >= 0) if end > 1 else np.arange(here)
            word = np.concatenate([word[on], open_])
            start = np.concatenate([start[on], np.full(len(open_), end - 1)])
            node = np.concatenate([node[on], np.zeros(len(open_), np.int64)])
            node = self.step.get(node * 257 + flat[begin[word] + end - 1]).astype(np.int64)
            on = node >= 0
            word, start, node = word[on], start[on], node[on]
            token = self.token_of[node]
            full = token >= 0
            w, s, t = choose(word[full], start[full], token[full])
            last[end, w], since[end, w] = t, s
            more = int(reaching[end])
            if marked and more < here:
                ending = word >= more
                closed = self.step.get(node[ending] * 257 + 256)
                full = closed >= 0
                w, s, t = choose(word[ending][full], start[ending][full], self.token_of[closed[full]])
                final[w], final_since[w] = t, s
            elif more < here:
                final[more:here], final_since[more:here] = last[end, more:here], since[end, more:here]
        taken, owners = [], []
        some, token, at = np.flatnonzero(sizes > 0), final, final_since
        token, at = final[some], final_since[some].astype(np.int64)
        if (token < 0).any():
            raise ValueError("a pre-token of known symbols has no encoding")
        while len(some):
            taken.append(token)
            owners.append(some)
            on = at > 0
            some, at = some[on], at[on]
            token, at = last[at, some], since[at, some].astype(np.int64)
        if not owners:
            return np.zeros(0, np.int32), np.zeros(n, np.int64)
        counts = np.bincount(np.concatenate(owners), minlength=n)
        stops, out = np.cumsum(counts), np.empty(int(counts.sum()), np.int32)
        for back, (own, token) in enumerate(zip(owners, taken)):
            out[stops[own] - 1 - back] = token
        return out, counts


@functools.lru_cache(maxsize=4)
def merge_table(path: str) -> MergeTable:
    return MergeTable(path)


@functools.lru_cache(maxsize=4)
def lock_step(path: str) -> LockStep:
    return LockStep(merge_table(path))


class Remembered:
    """What ``learn`` gives for the distinct cuts of a batch: a bounded memo, whose older half goes when it is full.

    ``learn`` takes a list of new cuts and gives a list of values; cuts longer than ``longest`` bytes aren't kept.
    """

    def __init__(self, learn, most: int = 250_000, longest: int = 64):
        self.learn, self.most, self.longest, self.known, self.older = learn, most, longest, {}, {}

    def values(self, cuts: list[bytes]) -> list:
        if len(self.known) > self.most // 2:
            self.known, self.older = {}, self.known
        known, older = self.known, self.older
        out = list(map(known.get, cuts))
        absent = [k for k, v in enumerate(out) if v is None]
        new = []
        for k in absent:
            out[k] = older.get(cuts[k])
            if out[k] is None:
                new.append(k)
        for k, value in zip(new, self.learn([cuts[k] for k in new])):
            out[k] = value
        longest = self.longest
        known.update((cuts[k], out[k]) for k in absent if len(cuts[k]) <= longest)
        return out

    def forget(self) -> None:
        self.known, self.older = {}, {}


#: Texts that stay as they are: with letters whose lower case needs care, with what may begin a special string, or with a
#: sign before a comma or full stop, which then belongs to a run of signs.
_CARE = r"[^\x{00}-\x{012f}\x{0132}-\x{0177}]|<\||[\x{00}-\x{08}\x{0e}-\x{1f}!-/:-@\[-`{-\x{a9}\x{ab}-\x{b4}\x{b6}-\x{bf}\x{d7}\x{f7}][.,]"


def plainer(texts: pa.Array) -> pa.Array:
    """Texts with fewer different cuts but the same tokens of a lower-case vocabulary without white space.

    In plain texts letters become small and a lone comma or full stop becomes a cut of its own.
    """
    small = pc.utf8_lower(texts)
    for lone, apart in ((", ", " , "), (". ", " . "), (".\n", " .\n")):
        small = pc.replace_substring(small, lone, apart)
    return pc.if_else(pc.match_substring_regex(texts, _CARE), texts, small)


def word_cuts(texts: list[str] | pa.Array) -> tuple[np.ndarray, np.ndarray, list[bytes]]:
    """All texts cut at ASCII white space, which no token of the lower-case word vocabulary crosses.

    Gives the number of each cut among the distinct ones, the end of each text in that list, and the distinct cuts.
    """
    column = texts if isinstance(texts, pa.Array) else pa.array(texts, pa.large_string())
    split = pc.ascii_split_whitespace(plainer(pc.fill_null(column.cast(pa.large_string()), "")))
    coded = pc.dictionary_encode(split.values.cast(pa.large_binary()))
    return coded.indices.to_numpy(), split.offsets.to_numpy()[1:], coded.dictionary.to_pylist()


def special_split(specials: Iterable[str]):
    """A pattern whose split keeps the special strings, or None without any."""
    own = sorted(specials, key=len, reverse=True)
    return regex.compile("(" + "|".join(map(regex.escape, own)) + ")") if own else None


class WordEncoder:
    """The lower-case word tokenizer: texts to ids, by their cuts; the ids of cuts are remembered.

    Cuts of plain small letters, digits and signs are split into pre-tokens here. The rest are made small and split by
    the library's own normaliser and pre-tokenizer, whose letter tables decide what a letter is.
    """

    #: Pre-tokens that lower case and NFC leave alone, next to any neighbour; an apostrophe can begin a suffix, so it isn't here.
    SMALL = "[a-zà-öø-ÿ]+|[0-9]|[!-&(-/:-@[-`{-~]+"
    is_small, split = re.compile(f"(?:{SMALL})+").fullmatch, re.compile(SMALL).findall

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        spec["model"] |= {"vocab": {}, "merges": []}  # only what comes before the model is used here
        lib = Tokenizer.from_str(json.dumps(spec))
        self.normal, self.pre_tokens = lib.normalizer.normalize_str, lib.pre_tokenizer.pre_tokenize_str
        self.machine = lock_step(path)
        self.specials, self.cut = self.machine.table.specials, special_split(self.machine.table.specials)
        self.bytes_of = {c: b for b, c in enumerate(byte_alphabet())}
        self.memo = Remembered(self.learn, most=100_000)

    def hard(self, text: str) -> list:
        """Pre-tokens (bytes) and special ids (numbers) of a cut that needs the library's tables."""
        out = []
        for part in self.cut.split(text) if self.cut and "<" in text else [text]:
            if part in self.specials:
                out.append(self.specials[part])
            elif part:
                out += [bytes(map(self.bytes_of.__getitem__, piece)) for piece, _ in self.pre_tokens(self.normal(part))]
        return out

    def learn(self, cuts: list[bytes]) -> list[bytes]:
        """The packed ids of each cut."""
        words, counts, special = [], [], []
        for raw in cuts:
            text = raw.decode("utf-8")
            if self.is_small(text) and "<|" not in text:
                if text.isalpha():
                    words.append(raw)
                    counts.append(1)
                else:
                    own = self.split(text)
                    words += [x.encode("utf-8") for x in own]
                    counts.append(len(own))
                continue
            own = self.hard(text)
            special += [(len(words) + k, x) for k, x in enumerate(own) if not isinstance(x, bytes)]
            words += [x if isinstance(x, bytes) else b"" for x in own]
            counts.append(len(own))
        ids, sizes = self.machine.encode(words)
        if special:
            places, values = np.asarray(special).T
            ids = np.insert(ids, (np.cumsum(sizes) - sizes)[places], values)
            sizes[places] = 1
        stops = np.concatenate([[0], np.cumsum(sizes)])[np.cumsum(counts, dtype=np.int64)] * 4 if cuts else []
        packed, at, out = ids.astype("<u4").tobytes(), 0, []
        for stop in map(int, stops):
            out.append(packed[at:stop])
            at = stop
        return out

    def encode(self, texts: list[str] | pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts, one after the other, and where each text's ids end."""
        return join_cuts(texts, self.memo)


def join_cuts(texts: list[str] | pa.Array, memo: Remembered) -> tuple[np.ndarray, np.ndarray]:
    """Ids of texts from the packed ids of their cuts."""
    which, stops, cuts = word_cuts(texts)
    rows = pa.array(memo.values(cuts), pa.large_binary()).take(pa.array(which))
    ends = np.frombuffer(rows.buffers()[1], np.int64)[: len(rows) + 1] // 4
    ids = np.frombuffer(rows.buffers()[2] or b"", "<u4")[: ends[-1]] if len(rows) else np.zeros(0, "<u4")
    return ids, ends[stops] if len(rows) else np.zeros(len(stops), np.int64)


@functools.lru_cache(maxsize=2)
def word_encoder(path: str) -> WordEncoder:
    return WordEncoder(path)


class JoinDecoder:
    """What the library does for a file without a decoder: token strings with one space between.

    States: nothing given out yet, or some token given out.
    """

    def __init__(self, table: MergeTable):
        most = max(table.strings)
        self.rows = pa.array([table.strings[i].encode("utf-8") + b" " if i in table.strings else b"" for i in range(most + 1)], pa.large_binary())
        self.started = False

    def push(self, ids: np.ndarray) -> str:
        out = _taken(self.rows, ids)[:-1]
        if out and self.started:
            out = b" " + out
        self.started |= bool(out)
        return out.decode("utf-8")

    def finish(self) -> str:
        self.started = False
        return ""


class TextDecoder:
    """Ids back to readable text: bytes of a token that end inside a character wait for the next token."""

    def __init__(self, table: MergeTable):
        back = {c: b for b, c in enumerate(byte_alphabet())}
        mark, own = table.suffix, []
        special = set(table.specials.values())
        for i in range(max(table.strings) + 1):
            s = table.strings.get(i, "")
            if i in special:
                own.append(s.encode("utf-8"))
                continue
            word_end = bool(mark) and s.endswith(mark)
            own.append(bytes(back[c] for c in (s[: -len(mark)] if word_end else s)) + b" " * word_end)
        self.rows = pa.array(own, pa.large_binary())
        self.state = codecs.getincrementaldecoder("utf-8")("replace")

    def push(self, ids: np.ndarray) -> str:
        return self.state.decode(_taken(self.rows, ids))

    def finish(self) -> str:
        out = self.state.decode(b"", final=True)
        self.state.reset()
        return out


def _taken(rows: pa.Array, ids: np.ndarray) -> bytes:
    """The bytes of the tokens, one after the other; ids that the file doesn't have give nothing."""
    ids = ids.astype(np.int64)
    if len(ids) and ids.max() >= len(rows):
        ids = ids[ids < len(rows)]
    got = rows.take(pa.array(ids))
    return got.buffers()[2].to_pybytes() if len(ids) and got.buffers()[2] else b""


def decoded(machine: JoinDecoder | TextDecoder, ids: np.ndarray, block: int = 65_536) -> str:
    """All of one document's ids through a decoding machine, a block at a time."""
    if len(ids) <= block:
        return machine.push(ids) + machine.finish()
    return "".join(machine.push(ids[k : k + block]) for k in range(0, len(ids), block)) + machine.finish()


def _encoded_batches(batches, path: str):
    encoder = word_encoder(path)
    for b in pieces(batches, 2 << 20):
        ids, ends = encoder.encode(b.column("text"))
        stops = np.concatenate([[0], ends]).astype(np.int64) * 4
        packed = pa.LargeBinaryArray.from_buffers(pa.large_binary(), b.num_rows, [None, pa.py_buffer(stops), pa.py_buffer(np.ascontiguousarray(ids, "<u4"))])
        yield pa.RecordBatch.from_arrays([b.column("doc_id"), packed.cast(pa.binary())], ["doc_id", "ids"])
    encoder.memo.forget()  # the worker lives on, and other jobs need its memory


def _decoded_batches(batches, path: str, forms: dict[str, type]):
    machines = {name: form(merge_table(path)) for name, form in forms.items()}
    for b in pieces(batches, name="ids"):
        own = [np.frombuffer(x or b"", "<u4") for x in b.column("ids").to_pylist()]
        out = [pa.array([decoded(machine, ids) for ids in own], pa.string()) for machine in machines.values()]
        yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("ids"), *out], ["doc_id", "ids", *machines])


def encode_documents(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, ids``: each whole text as packed little-endian 32-bit token ids (binary).

    A null or empty text has empty ids; a null id stays null; repeated rows give repeated rows; an empty table gives
    none. Other columns, whatever their names, aren't read. A very long text is worked on as one piece.
    """
    picked = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return picked.mapInArrow(lambda batches: _encoded_batches(batches, path), "doc_id long, ids binary")


def decode_documents(encoded: DataFrame, path: str, readable: bool = False) -> DataFrame:
    """``doc_id, ids, decoded``: packed ids as the library's own decode gives them, or as readable text.

    Null or empty ids give an empty text and are passed on as they are; ids that the file doesn't have give nothing;
    repeated rows give repeated rows. Columns other than ``doc_id`` and ``ids`` aren't read.
    """
    forms = {"decoded": TextDecoder if readable else JoinDecoder}
    return encoded.select("doc_id", "ids").mapInArrow(lambda batches: _decoded_batches(batches, path, forms), "doc_id long, ids binary, decoded string")


def round_trip(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, ids, decoded, readable``: ``encode_documents``, then both forms of decoding, in one pass.

    Nulls, empty texts, repeats and other columns as in ``encode_documents``.
    """
    picked = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    forms = {"decoded": JoinDecoder, "readable": TextDecoder}
    return picked.mapInArrow(lambda batches: _decoded_batches(_encoded_batches(batches, path), path, forms), "doc_id long, ids binary, decoded string, readable string")
