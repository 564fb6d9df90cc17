"""SentencePiece encoding by Gumbel top-k sampling without replacement, and decoding.

The lattice of a text has every vocabulary piece at every place it matches (a character without
a piece becomes its bytes).  A path's weight is the product of its pieces' weights: the model
file holds merge ranks, so a piece of rank r weighs 1 / (r + RANK_OFFSET), to the power ``alpha``.
Forward sums turn the lattice into a chain of choices (from each word's end to its start), and
the search samples from it without enumerating paths:

* The root region (all paths) has a Gumbel-perturbed maximum; its best path is an exact sample.
* A found path splits its region: for every choice of the path, the paths that agree before it
  and differ there form a region with a known mass.  Their maxima are Gumbel variables cut off
  at the parent's maximum.
* The region with the largest maximum is next (perturbed A*), so the paths come in descending
  order of their perturbed scores, all distinct, as if drawn one by one without replacement.
* The largest maximum left over after k paths is the threshold kappa; a path's inclusion score
  is 1 - exp(-exp(log p - kappa)).

No piece crosses the start of a space mark or a line feed, so the lattice is a chain of word
lattices; each distinct word's sums are computed once and kept in a bounded cache.  Random
numbers are hashes of (seed, row key, sample, place), so a row's samples do not depend on its
neighbours, the partitioning or a retry.  Regions of mass below e**-38 are left out: they cannot
be told from 0 next to 1 in double precision.

Defined results: a null or empty text has one sample without pieces, log_prob 0, inclusion 1; a
text with fewer than k segmentations has all of them, with inclusion 1; rows with the same key
and text have the same samples; a null key counts as 0; ties have probability 0; an empty table
gives an empty table; of further columns those named in ``keep`` pass through.
"""

from __future__ import annotations

import heapq
import math
import re
from bisect import bisect_right
from collections import defaultdict
from collections.abc import Iterator
from hashlib import sha256
from itertools import accumulate, count, islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartlens.llm.common import mix64, texts_of, xxhash64_long

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
SPACE = "▁"
RANK_OFFSET = 10.0
FIRST_BYTE, FIRST_PIECE = 3, 259
FALLBACK = 1 << 20                  # + code point: a character that has no piece
LONG_WORD = 48                      # longer words are summed one by one
LIGHT = -38.0                       # log mass of regions that are left out
MAX_STATES = 1 << 21                # states in the cache
BYTES_AT_ONCE = 1 << 20             # of texts that are sampled together, one text at least
AHEAD = 512                         # choices of a path that are looked at first for regions
SLOT_BITS = 19
_WORD = re.compile(f"{SPACE}+[^{SPACE}\n]*|[^{SPACE}\n]+|\n")
_BASE = np.uint64(0x9E3779B97F4A7C15)
_STEP, _SAMPLE, _PLACE = (np.uint64(x) for x in (0xD1B54A32D192ED03, 0x8CB92BA72F3D8DD7, 0xABC98388FB8FAC03))


def _times(factor: np.uint64, n: int) -> np.uint64:
    return np.uint64(int(factor) * n & 0xFFFFFFFFFFFFFFFF)


def load_pieces(model: str = MODEL) -> list[str]:
    import sentencepiece
    sp = sentencepiece.SentencePieceProcessor(model_file=model)
    return [sp.id_to_piece(i) for i in range(sp.get_piece_size())]


def normalise(text: str | None) -> str:
    return SPACE + text.replace(" ", SPACE) if text else ""


def _hash(text: str) -> int:
    h = 0
    for c in text:
        h = (h * int(_BASE) + ord(c) + 1) & 0xFFFFFFFFFFFFFFFF
    return h


def _slot(hashes: np.ndarray) -> np.ndarray:
    return ((hashes ^ (hashes >> np.uint64(32))) * _SAMPLE) >> np.uint64(64 - SLOT_BITS)


def vocabulary(pieces: list[str], alpha: float = 1.0) -> dict:
    """Lookup tables of the pieces (sorted by hash), with their log weights."""
    ids = range(FIRST_PIECE, len(pieces))
    hashes = np.array([_hash(pieces[i]) for i in ids], np.uint64)
    order = np.argsort(hashes)
    rank = np.arange(len(pieces) - FIRST_PIECE)
    weight = -alpha * np.log(rank + RANK_OFFSET)
    hashes = hashes[order]
    slots, where, left = np.full(1 << SLOT_BITS, -1, np.int32), _slot(hashes), np.arange(len(hashes))
    probes = 0
    while len(left):                    # open addressing: the first that comes takes the slot
        at = ((where[left] + np.uint64(probes)) % np.uint64(len(slots))).astype(np.int64)
        free = slots[at] < 0
        slots[at[free][::-1]] = left[free][::-1]
        left = left[slots[at] != left]
        probes += 1
    return {"slots": slots, "probes": probes, "hash": hashes, "id": np.array(ids, np.int64)[order], "weight": weight[order],
            "len": np.array([len(pieces[i]) for i in ids])[order], "longest": max(map(len, pieces[FIRST_PIECE:])),
            "byte": -alpha * math.log(len(pieces) + RANK_OFFSET),
            "of": {pieces[i]: (i, float(weight[i - FIRST_PIECE])) for i in ids}}


class Lattices:
    """Choices of the distinct words seen: state (word, place) -> edges with their probabilities."""

    def __init__(self, vocab: dict):
        self.v = vocab
        self.powers = np.concatenate(([np.uint64(1)], np.cumprod(np.full(vocab["longest"], _BASE))))
        self.clear()

    def clear(self) -> None:
        self.number: defaultdict[str, int] = defaultdict(count().__next__)
        self.base, self.length = np.empty(0, np.int64), np.empty(0, np.int64)
        self.states = 0
        # By edge: cumulated probability in its state (in 2**-30), log probability, characters, piece.
        self.upto, self.lp, self.step, self.piece = (np.empty(0, t) for t in (np.uint32, np.float32, np.int8, np.int32))
        self.first = np.zeros(1, np.int32)          # a state's first edge; the last entry: all edges

    def numbers(self, words: list[str]) -> list[int]:
        return list(map(self.number.__getitem__, words))

    def settle(self) -> None:
        """Sum the lattices of the new words (their marks may be spaces) and add their states."""
        words = list(islice(self.number, len(self.base), None))
        if not words:
            return
        n = np.fromiter(map(len, words), np.int64, len(words))
        each = np.array(words, object)
        base = np.zeros(len(words), np.int64)
        parts: list[tuple] = []
        low = 0
        for high in (*range(1, 21), 28, LONG_WORD):
            at = np.flatnonzero((n > low) & (n <= high))
            for k in range(0, len(at), size := max(1, 400_000 // (high * min(high, self.v["longest"])))):
                parts.append(self._block(each[at[k:k + size]].tolist(), n[at[k:k + size]], base, at[k:k + size]))
            low = high
        for i in np.flatnonzero(n > LONG_WORD):
            parts.append(self._single(words[i].replace(" ", SPACE), base, i))
        columns = [list(c) for c in zip(*parts)]
        del parts
        edges = len(self.lp) + np.cumsum(np.concatenate(columns[0]), dtype=np.int64)
        self.first = np.concatenate([self.first, edges.astype(np.int32)])
        for name, new in zip(("upto", "lp", "step", "piece"), columns[1:]):     # one at a time: the old one goes first
            setattr(self, name, np.concatenate([getattr(self, name), *new]))
            new.clear()
        self.base, self.length = np.append(self.base, base), np.append(self.length, n)

    def _block(self, words: list[str], n: np.ndarray, base: np.ndarray, at: np.ndarray) -> tuple:
        v, rows, wide = self.v, len(words), int(n.max())
        most = min(wide, v["longest"])
        flat = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), np.uint32)
        short = int(n.min()) < wide
        inside = np.arange(wide)[:, None] < n
        # Place first, then length, then word: hashes and sums run along the words.
        cp = np.zeros((rows, wide), np.int64)
        cp[inside.T] = np.where(flat == 32, ord(SPACE), flat)
        cp = np.ascontiguousarray(cp.T)
        h = np.zeros((wide + 1, rows), np.uint64)
        for t in range(wide):
            h[t + 1] = h[t] * _BASE + (cp[t] + 1).astype(np.uint64)
        score = np.full((wide, most, rows), -np.inf)
        place = np.zeros((wide, most, rows), np.int32)
        for m in range(1, most + 1):
            k, cell = self._find((h[m:] - h[:-m] * self.powers[m]).ravel())
            t, r = np.divmod(cell, rows)
            if short:
                good = inside[t + m - 1, r]
                k, t, r = k[good], t[good], r[good]
            cell = ((t + m - 1) * most + m - 1) * rows + r
            score.ravel()[cell], place.ravel()[cell] = v["weight"].take(k), v["id"].take(k)
        t, r = np.nonzero(inside & np.isneginf(score[:, 0]))        # no piece: the character's bytes
        if len(r):
            c = cp[t, r]
            score[t, 0, r] = v["byte"] * (1 + (c >= 0x80) + (c >= 0x800) + (c >= 0x10000))
            place[t, 0, r] = np.where(c < 0x80, FIRST_BYTE, FALLBACK) + c
        there = np.ascontiguousarray((score > -np.inf).transpose(2, 0, 1))     # by word, place, length: as the states are
        total = np.full((wide + 1, rows), -np.inf)
        total[0] = 0.0
        with np.errstate(divide="ignore", invalid="ignore"):
            for t in range(wide):
                m = min(t + 1, most)
                x = score[t, :m]
                x += total[t::-1][:m]
                top = x.max(axis=0)
                top[np.isneginf(top)] = 0.0
                total[t + 1] = top + np.log(np.exp(x - top).sum(axis=0))
                x -= total[t + 1]
        e = np.flatnonzero(there)
        lp = score.transpose(2, 0, 1).ravel().take(e)
        piece = place.transpose(2, 0, 1).ravel().take(e)
        step = (e.astype(np.uint32) % np.uint32(most) + np.uint32(1)).astype(np.int8)
        size = there.sum(axis=2)[inside.T]
        base[at] = np.cumsum(n) - n + self.states
        self.states += int(n.sum())
        # Whole numbers add up exactly, so a word's entries do not depend on the words around it.
        p = np.cumsum((np.exp(lp) * 2.0 ** 40).astype(np.int64))
        last = np.cumsum(size) - 1
        before = np.append(0, p[last[:-1]])
        upto = np.minimum((p - np.repeat(before, size)) / np.repeat(p[last] - before, size), 1.0)
        upto[last] = 1.0
        return size, _thirty_bits(upto), lp.astype(np.float32), step, piece

    def _find(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Of the hashes that are in the vocabulary: their places there and here."""
        slots, known = self.v["slots"], self.v["hash"]
        at = _slot(hashes).astype(np.int64)
        k = slots.take(at)
        i = np.flatnonzero(k >= 0)
        k, at, hashes = k.take(i), at.take(i), hashes.take(i)
        hit = known.take(k) == hashes
        open_ = np.flatnonzero(~hit)
        for p in range(1, self.v["probes"]):
            if not len(open_):
                break
            n = slots[(at[open_] + p) % len(slots)]
            good = (n >= 0) & (known[n] == hashes[open_])
            k[open_[good]], hit[open_[good]] = n[good], True
            open_ = open_[(n >= 0) & ~good]
        return k[hit], i[hit]

    def _single(self, word: str, base: np.ndarray, at: int) -> tuple:
        of, longest = self.v["of"], self.v["longest"]
        total, size, upto, lps, step, piece = [0.0], [], [], [], [], []
        base[at] = self.states
        for t in range(1, len(word) + 1):
            edges = []
            for m in range(1, min(t, longest) + 1):
                got = of.get(word[t - m:t])
                if got is None and m == 1:
                    c = ord(word[t - 1])
                    got = (FIRST_BYTE + c if c < 0x80 else FALLBACK + c, self.v["byte"] * (1 + (c >= 0x80) + (c >= 0x800) + (c >= 0x10000)))
                if got is not None:
                    edges.append((m, got[0], got[1] + total[t - m]))
            top = max(e[2] for e in edges)
            total.append(top + math.log(sum(math.exp(e[2] - top) for e in edges)))
            cum = 0.0
            for k, (m, i, s) in enumerate(edges):
                cum += math.exp(s - total[t])
                upto.append(1.0 if k + 1 == len(edges) else min(cum, 1.0))
                lps.append(s - total[t]), step.append(m), piece.append(i)
            size.append(len(edges))
            self.states += 1
        return np.array(size), _thirty_bits(np.array(upto)), np.array(lps, np.float32), np.array(step, np.int8), np.array(piece, np.int32)

    def draw(self, words: np.ndarray, salt: np.ndarray, order: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """A sampled path of each word: edges (from the word's end to its start), their counts and
        the pieces in reading order.  ``order`` sorts the words: equal ones read the same entries."""
        w = words[order]
        start, salt = self.base[w] - 1, salt[order]
        state, live, steps, taken = start + self.length[w], np.arange(len(w)), [], np.zeros(len(w), np.int32)
        while len(live):
            u = (mix64(salt + _times(_STEP, len(steps) + 1)) >> np.uint64(34)).astype(np.uint32)
            e = self.first.take(state)
            more = np.flatnonzero(self.upto.take(e) <= u)
            past, mine = u.take(more), e.take(more)
            while len(more):
                mine += 1
                e[more] = mine
                on = np.flatnonzero(self.upto.take(mine) <= past)
                more, past, mine = more.take(on), past.take(on), mine.take(on)
            steps.append((live, e))
            taken[live] += 1
            state = state - self.step.take(e)
            go = np.flatnonzero(state > start)
            live, state, start, salt = live.take(go), state.take(go), start.take(go), salt.take(go)
        n = np.empty(len(w), np.int32)
        n[order] = taken
        end = np.cumsum(n, dtype=np.int64)
        out, read = (np.empty(int(end[-1]) if len(end) else 0, np.int32) for _ in range(2))
        begin, end = (end - n)[order], end[order] - 1
        for s, (k, e) in enumerate(steps):
            out[begin[k] + s] = e
            read[end[k] - s] = self.piece.take(e)
        return out, n, read


def _thirty_bits(p: np.ndarray) -> np.ndarray:
    """Smallest whole number of 2**-30 that is not below each probability."""
    return np.ceil(p * 1073741824.0).astype(np.uint32)


def _mixed(x: int) -> int:
    """``mix64`` of one number."""
    x ^= x >> 33
    x = x * 0xFF51AFD7ED558CCD & 0xFFFFFFFFFFFFFFFF
    x ^= x >> 33
    x = x * 0xC4CEB9FE1A85EC53 & 0xFFFFFFFFFFFFFFFF
    return x ^ (x >> 33)


def _uniform(key: int, path: int, lo: int, n: int) -> np.ndarray:
    """Numbers in (0, 1) for the choices lo, lo + 1, ... of a path."""
    seed = _mixed(_mixed(int(key)) + path * int(_PLACE) & 0xFFFFFFFFFFFFFFFF)
    x = mix64(np.arange(lo, lo + n, dtype=np.uint64) * _STEP + np.uint64(seed))
    return ((x >> np.uint64(11)).astype(float) + 0.5) / 9007199254740992.0


class _Text:
    """Search state of one text: its words, found paths (edges, counts) and open regions."""

    def __init__(self, words: np.ndarray, key: np.uint64):
        self.words, self.key = words, key
        # edges, counts by word, log p, perturbed score, pieces in reading order
        self.paths: list[tuple[np.ndarray, np.ndarray, float, float, np.ndarray]] = []
        self.regions: list[tuple[float, int, int, tuple[int, ...]]] = []       # -maximum, path, choice, taken there
        self.next: tuple | None = None

    def split(self, lat: Lattices, edges: np.ndarray, top: float, since: int, taken: tuple[int, ...], most: int,
              rest: float | None) -> None:
        """Open the regions that leave the newest path at its choice ``since`` or later.

        Of them only the ``most`` with the largest maxima can still be asked for.  ``rest`` is
        the probability left at choice ``since`` when some edges are taken already.
        """
        for ahead in (512, len(edges)):
            lp = lat.lp[edges[:since + ahead]].astype(float)
            before = np.cumsum(lp) - lp
            if before[-1] < LIGHT:
                break
        stop = max(since + 1, int(np.searchsorted(-before, -LIGHT, side="right")))
        lp, before = lp[since:stop], before[since:stop]
        with np.errstate(divide="ignore", over="ignore"):
            mass = np.log(-np.expm1(lp))
            if rest is not None and len(mass):
                mass[0] = np.log(rest)
            mass += before
            noise = -np.log(_uniform(self.key, len(self.paths), since, len(lp)))
            best = -np.log(math.exp(-top) + np.exp(-mass) * noise)
        for d in np.argsort(-best, kind="stable")[:most].tolist():
            if best[d] > -np.inf:
                heapq.heappush(self.regions, (-float(best[d]), len(self.paths) - 1, since + d,
                                              (*taken, int(edges[since])) if d == 0 else (int(edges[since + d]),)))


def _split_all(lat: Lattices, newest: list[tuple], keys: np.ndarray, s: int, most: int) -> None:
    """``split`` for the newest paths (text, edges, their log probabilities, top, since, taken,
    rest) of many texts at once; those that need more than AHEAD choices go one by one."""
    rows = len(newest)
    size = np.array([min(len(x[1]), AHEAD) for x in newest])
    since = np.array([x[4] for x in newest])
    at = np.arange(AHEAD)
    lp = np.zeros((rows, AHEAD))
    lp[at < size[:, None]] = np.concatenate([x[2][:AHEAD] for x in newest])
    before = np.cumsum(lp, axis=1) - lp
    whole = (before[:, -1] < LIGHT) | (size == [len(x[1]) for x in newest])
    light = before < LIGHT
    stop = np.minimum(np.where(light.any(axis=1), light.argmax(axis=1), AHEAD), size)
    stop = np.maximum(since + 1, stop)
    whole &= stop <= size
    wide = int(stop[whole].max(initial=0))
    row, at = np.nonzero((at[:wide] >= since[:, None]) & (at[:wide] < stop[:, None]))
    seeds = mix64(mix64(keys) + _times(_PLACE, s + 1))
    x = mix64(at.astype(np.uint64) * _STEP + seeds[row])
    noise = -np.log(((x >> np.uint64(11)).astype(float) + 0.5) / 9007199254740992.0)
    best = np.full((rows, wide), -np.inf)
    with np.errstate(divide="ignore", over="ignore", invalid="ignore"):
        mass = np.log(-np.expm1(lp[row, at]))
        rest = np.array([np.nan if x[6] is None else x[6] for x in newest])[row]
        cut = np.flatnonzero((at == since[row]) & ~np.isnan(rest))
        mass[cut] = np.log(rest[cut])
        mass += before[row, at]
        best[row, at] = -np.log(np.array([math.exp(-x[3]) for x in newest])[row] + np.exp(-mass) * noise)
    row = np.arange(rows)
    for _ in range(min(most, wide)):
        d = best.argmax(axis=1)
        value = best[row, d].tolist()
        best[row, d] = -np.inf
        for (t, e, _, _, first, taken, _), ok, b, c in zip(newest, whole.tolist(), value, d.tolist()):
            if ok and b > -np.inf:
                heapq.heappush(t.regions, (-b, len(t.paths) - 1, c, (*taken, int(e[c])) if c == first else (int(e[c]),)))
    for i in np.flatnonzero(~whole):
        t, e, _, top, first, taken, rest = newest[i]
        t.split(lat, e, top, first, taken, most, rest)


def sample_paths(lat: Lattices, texts: list[np.ndarray], keys: np.ndarray, k: int) -> list[tuple[_Text, float]]:
    """The k best perturbed paths of each text (word numbers) and its threshold kappa."""
    found = [_Text(w, key) for w, key in zip(texts, keys)]
    if not found:
        return []
    size = np.array([len(w) for w in texts])
    words = np.concatenate(texts)
    owner = np.repeat(np.arange(len(texts)), size)
    place = np.arange(len(words)) - (np.cumsum(size) - size)[owner] + 1
    salt = keys[owner] + _PLACE * place.astype(np.uint64)
    order = np.argsort(words, kind="stable")
    step = int(_STEP)
    for s in range(k):
        asked = []
        since_word = np.full(len(texts), len(words))               # words from there on are drawn anew
        for i, t in enumerate(found):
            w = 0
            if s:
                if not t.regions:
                    continue
                t.next = heapq.heappop(t.regions)
                _, path, choice, _ = t.next
                w = int(t.paths[path][1].cumsum().searchsorted(choice, side="right")) + 1
            asked.append((i, t, w))
            since_word[i] = w
        if not asked:
            break
        fresh = place > since_word[owner]
        at = (np.cumsum(fresh) - 1)[order[fresh[order]]]
        edges, counts, read = lat.draw(words[fresh], mix64(salt[fresh] + _times(_SAMPLE, s + 1)), at)
        which = [i for i, _, _ in asked]
        word_end = np.cumsum(size[which] - np.array([w for _, _, w in asked]))
        edge_end = np.append(0, np.cumsum(counts))[word_end]
        lps = lat.lp.take(edges)
        asked_keys = keys[which]
        seeds = mix64(mix64(asked_keys) + _times(_PLACE, -1 - s)).tolist()
        firsts = _uniform_first(asked_keys) if s == 0 else []
        newest, open_ = [], []
        w0 = e0 = 0
        for j, ((_, t, w), w1, e1) in enumerate(zip(asked, word_end.tolist(), edge_end.tolist())):
            e, c, ids, lp = edges[e0:e1], counts[w0:w1], read[e0:e1], lps[e0:e1]
            w0, e0 = w1, e1
            if s == 0:
                top, since, taken, rest = -math.log(-math.log(firsts[j])), 0, (), None
            else:
                top, (_, path, since, taken) = -t.next[0], t.next
                old, old_c, _, _, old_ids = t.paths[path]
                head = int(old_c[:w - 1].sum())                    # choices before the word that changes
                mine = old[head:since].tolist()
                word = t.words[w - 1]
                base = int(lat.base[word]) - 1
                left = int(lat.length[word] - lat.step[old[head:since]].sum())
                i = 0
                while left > 0:
                    options = range(*lat.first[base + left:base + left + 2].tolist())
                    p = np.exp(lat.lp[options.start:options.stop].astype(float))
                    if i == 0:
                        options = [x for x in options if x not in taken]
                        p = p[[x - lat.first[base + left] for x in options]]
                    u = ((_mixed((since + i) * step + seeds[j] & 0xFFFFFFFFFFFFFFFF) >> 11) + 0.5) / 9007199254740992.0
                    ends = list(accumulate(p.tolist()))
                    pick = min(bisect_right(ends, u * ends[-1]), len(ends) - 1)
                    if i == 0:
                        rest = float(np.concatenate((p[:pick], p[pick + 1:])).sum())
                    mine.append(options[pick])
                    left -= int(lat.step[options[pick]])
                    i += 1
                new = np.array(mine, np.int32)
                e = np.concatenate((old[:head], new, e))
                c = np.concatenate((old_c[:w - 1], np.array([len(mine)], np.int32), c))
                ids = np.concatenate((old_ids[:head], lat.piece[new[::-1]], ids))
                lp = np.concatenate((lat.lp[e[:head + len(mine)]], lp))
            t.paths.append((e, c, float(lp.sum(dtype=float)), top, ids))
            if len(e):
                newest.append((t, e, lp, top, since, taken, rest))
                open_.append(j)
        if newest:
            _split_all(lat, newest, asked_keys[open_], s, k - s)
    return [(t, -t.regions[0][0] if t.regions else -math.inf) for t in found]


def _uniform_first(keys: np.ndarray) -> list[float]:
    """``_uniform`` of each key for path 0 and choice 0."""
    return (((mix64(mix64(mix64(keys))) >> np.uint64(11)).astype(float) + 0.5) / 9007199254740992.0).tolist()


def numbered(lat: Lattices, texts: list[str | None]) -> list[np.ndarray]:
    """The numbers of the words (``_WORD``) of each normalised text, its marks written as spaces.

    A word goes through Python once, not at each of its places.
    """
    raw = [b" " + t.replace(SPACE, " ").encode() if t else b"" for t in texts]
    blob = np.frombuffer(b"".join(raw), np.uint8)
    if not len(blob):
        return [np.empty(0, np.int64) for _ in raw]
    end = np.cumsum([len(x) for x in raw])
    mark, line = blob == 32, blob == 10
    new = line.copy()                   # marks with what follows, or a line feed
    new[1:] |= line[:-1] | (mark[1:] & ~mark[:-1])
    begin = np.append(0, end[:-1])
    new[begin[begin < len(blob)]] = True
    start = np.flatnonzero(new)
    offsets = np.append(start, len(blob))
    coded = pa.LargeStringArray.from_buffers(len(start), pa.py_buffer(offsets), pa.py_buffer(blob)).dictionary_encode()
    numbers = np.array(lat.numbers(coded.dictionary.to_numpy(zero_copy_only=False).tolist()), np.int64)[coded.indices.to_numpy()]
    return np.split(numbers, np.searchsorted(start, end[:-1]))


def _ids(pieces: np.ndarray) -> np.ndarray:
    """Piece ids; a character without a piece becomes its bytes."""
    if (pieces >= FALLBACK).any():
        out: list[int] = []
        for i in pieces.tolist():
            out += [FIRST_BYTE + b for b in chr(i - FALLBACK).encode("utf-8", "surrogatepass")] if i >= FALLBACK else [i]
        pieces = np.array(out)
    return pieces.astype(np.uint16)


def ids_of_all(paths: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """``_ids`` of many paths in one array, and where each path ends in it."""
    flat = np.concatenate([np.empty(0, np.int32), *paths])
    end = np.cumsum([len(x) for x in paths], dtype=np.int64)
    bare = flat >= FALLBACK
    if bare.any():
        chars = [chr(c).encode("utf-8", "surrogatepass") for c in (flat[bare] - FALLBACK).tolist()]
        times = np.ones(len(flat), np.int64)
        times[bare] = [len(c) for c in chars]
        end = np.append(0, np.cumsum(times))[end]
        flat = np.repeat(flat, times)
        flat[np.repeat(bare, times)] = FIRST_BYTE + np.frombuffer(b"".join(chars), np.uint8).astype(np.int32)
    return flat.astype(np.uint16), end


def encode(docs: DataFrame, k: int = 2, model: str = MODEL, alpha: float = 1.0, seed: int = 42, key: str = "doc_id",
           text: str = "text", keep: tuple[str, ...] = (), read_back: bool = False) -> DataFrame:
    """Up to ``k`` sampled segmentations a row: key, sample, tokens, n_pieces, log_prob,
    perturbed and inclusion; ``tokens`` are 16-bit little-endian piece ids.  ``read_back`` decodes
    them where they are made and adds decoded_sha256, the digest of that text."""
    spark = docs.sparkSession
    sent = spark.sparkContext.broadcast(vocabulary(load_pieces(model), alpha))
    back = spark.sparkContext.broadcast(text_bytes(piece_bytes(model))) if read_back else None
    results = ["sample", "tokens", "n_pieces", "log_prob", "perturbed", "inclusion", *["decoded_sha256"] * read_back]
    keep = tuple(c for c in dict.fromkeys((key, *keep)) if c.lower() not in results)
    names = [*keep, *results]

    def rows(batch: pa.RecordBatch, at: range, found: list[tuple[_Text, float]]) -> pa.RecordBatch:
        where, sample, pieces_of, lps, tops, inc = [], [], [], [], [], []
        for i, (t, kappa) in zip(at, found):
            for s, (_, _, lp, top, pieces) in enumerate(t.paths):
                where.append(i), sample.append(s), pieces_of.append(pieces), lps.append(lp), tops.append(top)
                inc.append(1.0 if kappa == -math.inf else -math.expm1(-math.exp(min(700.0, lp - kappa))))
        ids, end = ids_of_all(pieces_of)
        n, raw = np.diff(end, prepend=0), memoryview(ids).cast("B")
        tokens = [bytes(raw[2 * (j - m):2 * j]) for j, m in zip(end.tolist(), n.tolist())]
        cols = [batch.column(c).take(pa.array(where)) for c in keep]
        digests = [] if back is None else [pa.array([sha256(x).hexdigest() for x in decoded(ids, end, back.value)], pa.string())]
        return pa.RecordBatch.from_arrays([*cols, pa.array(sample, pa.int32()), pa.array(tokens, pa.binary()), pa.array(n, pa.int32()),
                                           pa.array(lps, pa.float64()), pa.array(tops, pa.float64()), pa.array(inc, pa.float64()),
                                           *digests], names=names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lat = Lattices(sent.value)
        for batch in batches:
            ids = np.array([x or 0 for x in batch.column("__key").to_pylist()], np.int64)
            salts = mix64(xxhash64_long(ids).view(np.uint64) + np.uint64(seed))
            texts: list[str | None] = []
            held = 0
            for i, t in enumerate(texts_of(batch, "__text")):
                texts.append(t)
                held += len(t or "")
                if held >= BYTES_AT_ONCE or i + 1 == batch.num_rows:
                    at = range(i + 1 - len(texts), i + 1)
                    numbers = numbered(lat, texts)
                    lat.settle()
                    yield rows(batch, at, sample_paths(lat, numbers, salts[at.start:at.stop], k))
                    texts, held = [], 0
                    if lat.states > MAX_STATES:
                        lat.clear()

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.select(*keep).schema)
    kind = docs.schema[key].dataType.typeName()
    number = F.col(key).cast("long") if kind in ("long", "integer", "short", "byte") else F.xxhash64(F.col(key))
    return docs.select(*keep, number.alias("__key"), F.col(text).alias("__text")).mapInArrow(
        run, f"{fields}, sample int, tokens binary, n_pieces int, log_prob double, perturbed double, inclusion double"
        + ", decoded_sha256 string" * read_back)


def decode_ids(tokens: bytes | None, pieces: list[bytes]) -> str:
    """Text of 16-bit piece ids: pieces joined, the leading space mark dropped, marks to spaces."""
    raw = b"".join(map(pieces.__getitem__, np.frombuffer(tokens or b"", np.uint16).tolist()))
    return raw.decode("utf-8", "surrogatepass").replace(SPACE, " ")[1:]


def text_bytes(pieces: list[bytes]) -> pa.LargeBinaryArray:
    """What each piece stands for in a text: its marks are spaces."""
    return pa.array([p.replace(SPACE.encode(), b" ") for p in pieces], pa.large_binary())


def decoded(ids: np.ndarray, end: np.ndarray, pieces: pa.LargeBinaryArray) -> Iterator[memoryview]:
    """The UTF-8 texts of many sequences of ids (``end``: where each ends), without the leading mark.

    The bytes of all pieces are joined at once.  A mark is a piece of the vocabulary, never its bytes.
    """
    joined = pieces.take(pa.array(ids))
    if not len(joined):
        yield from (memoryview(b"") for _ in end)
        return
    at = np.frombuffer(joined.buffers()[1], np.int64)[joined.offset:][np.append(0, end)].tolist()
    raw = memoryview(joined.buffers()[2])
    for lo, hi in zip(at, at[1:]):
        yield raw[lo + 1:hi] if hi > lo else raw[:0]


def piece_bytes(model: str = MODEL) -> list[bytes]:
    out = [p.encode() for p in load_pieces(model)]
    out[FIRST_BYTE:FIRST_PIECE] = [bytes([b]) for b in range(256)]
    return out


def decode(encoded: DataFrame, model: str = MODEL, tokens: str = "tokens") -> DataFrame:
    """``encoded`` with the column ``decoded``: the text of the tokens."""
    sent = encoded.sparkSession.sparkContext.broadcast(piece_bytes(model))
    own = [c for c in encoded.columns if c.lower() != "decoded"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [decode_ids(t.as_py(), sent.value) for t in batch.column(tokens)]
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in own], pa.array(texts, pa.string())], names=[*own, "decoded"])

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in encoded.select(*own).schema)
    return encoded.select(*own).mapInArrow(run, f"{fields}, decoded string")


def query(docs: DataFrame, k: int = 4) -> DataFrame:
    return encode(docs.select("doc_id", "text"), k, read_back=True).select(
        "doc_id", "sample", "n_pieces", "log_prob", "perturbed", "inclusion", F.sha2("tokens", 256).alias("tokens_sha256"),
        "decoded_sha256")
