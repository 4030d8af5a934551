"""Plain Python versions of the operators, written apart from them."""

import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict


def shingles(text, pattern=rb"[^\x20\x09-\x0D]+"):
    w = re.findall(pattern, (text or "").encode().lower())
    return {tuple(w[j : j + 5]) for j in range(max(1, len(w) - 4))} if w else set()


def components(rows):
    """Least id that each id reaches over links of Jaccard 0.75."""
    root = {i: i for i in rows}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    sets = {i: shingles(t) for i, t in rows.items()}
    holders = defaultdict(list)
    for i in sorted(rows):
        for s in sets[i]:
            holders[s].append(i)
    pairs = Counter((a, b) for ids in holders.values() for n, a in enumerate(ids) for b in ids[n + 1 :])
    for (i, j), both in pairs.items():
        if 100 * both >= 75 * (len(sets[i]) + len(sets[j]) - both):
            a, b = find(i), find(j)
            root[max(a, b)] = min(a, b)
    return {i: find(i) for i in rows}


def contaminated(docs, items):
    grams = lambda t: (lambda w: {tuple(w[j : j + 5]) for j in range(max(1, len(w) - 4))} if w else set())([x.encode().lower() for x in re.findall("[A-Za-z0-9\u0080-\U0010ffff]+", t or "")])
    known = {i: g for i, t in items if (g := grams(t))}
    return {d for d, t in docs if any(100 * len(g & mine) >= 75 * len(g) for mine in [grams(t)] for g in known.values())}


class Language:
    """Word-first backoff with dictionaries."""

    ORDERS, TEMPER = (4, 3, 2, 1), 20

    def __init__(self, rows):
        by, total = {k: defaultdict(Counter) for k in (0, *self.ORDERS)}, Counter()
        for text, lang in rows:
            for w in self.words(text):
                for kind in by:
                    for key in [w] if kind == 0 else self.grams(w, kind):
                        by[kind][key][lang] += 1
                        total[lang, kind] += 1
        self.langs = sorted({lang for _, lang in rows})
        self.known = {kind: {k: c for k, c in found.items() if kind or max(c.values()) > 1} for kind, found in by.items()}
        self.total = total

    @staticmethod
    def words(text):
        return re.findall("[^\x01]+", "".join(c if c.isalpha() else "\x01" for c in (text or "").lower()))

    @staticmethod
    def grams(w, n):
        w = f"\x01{w}\x01"
        return [w[i : i + n] for i in range(len(w) - n + 1)]

    def _log(self, kind, key, lang):
        return math.log((self.known[kind][key][lang] + 0.5) / (self.total[lang, kind] + 0.5 * (len(self.known[kind]) + 1)))

    def word(self, w, lang):
        if w in self.known[0]:
            return self._log(0, w, lang)
        for n in self.ORDERS:
            if found := [g for g in self.grams(w, n) if g in self.known[n]]:
                return sum(self._log(n, g, lang) for g in found) / len(found)
        return 0.0

    def judge(self, text):
        words = self.words(text)
        if not words:
            return "und", 0.0, 0, 0
        sums = {lang: sum(self.word(w, lang) for w in words) * min(len(words), self.TEMPER) / len(words) for lang in self.langs}
        top = max(sums.values())
        share = {lang: math.exp(s - top) for lang, s in sums.items()}
        best = max(self.langs, key=lambda x: share[x])
        return best, share[best] / sum(share.values()), len(words), sum(w in self.known[0] for w in words)

    def accepts(self, text):
        lang, score, n, known = self.judge(text)
        return lang != "und" and score >= 0.4 and (n < 10 or known >= 0.2 * n)


def targets(sizes, share=1.5, most=2, weights=(5, 2, 1)):
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    w = {s: weights[i % 3] for i, s in enumerate(names)}
    left, free, out = share * sum(sizes.values()), list(names), {}
    while free:
        level = left / sum(w[s] for s in free)
        full = [s for s in free if level * w[s] > most * sizes[s]]
        if not full:
            return out | {s: level * w[s] for s in free}
        for s in full:
            out[s] = most * sizes[s]
            left -= out[s]
            free.remove(s)
    return out


def mixed(rows):
    """{id: times} of (id, source, text) rows with ids of their own, by virtual finish times."""
    size = {i: len(re.findall(r"[^\x20\x09-\x0D]+", t or "")) for i, _, t in rows}
    sizes = Counter()
    for i, s, _ in rows:
        sizes[s] += size[i]
    aim = targets(sizes)
    h = {i: hashlib.md5(f"{i}:{hashlib.md5((t or '').encode()).hexdigest()}".encode()).hexdigest() for i, _, t in rows}
    rank = {s: k for k, s in enumerate(sorted(sizes, key=lambda s: (s is None, s or "")))}
    passes, upto = [], Counter()
    for i, s, _ in sorted(rows, key=lambda r: h[r[0]]):
        upto[s] += size[i]
        if size[i]:
            passes += [((upto[s] + k * sizes[s]) / aim[s], rank[s], h[i], i) for k in (0, 1)]
    left, times = 1.5 * sum(sizes.values()), Counter()
    for _, _, _, i in sorted(passes):
        if size[i] > left:
            break
        left -= size[i]
        times[i] += 1
    return times


def placed(rows, shards, seed=7):
    """(id, shard, slot) of (id, text) rows."""
    n = len(rows)
    a = max(1, math.isqrt(n))
    b = max(1, -(-n // a))
    digest = lambda x, k: int(hashlib.md5(f"{x}:{k}:{seed}".encode()).hexdigest()[:8], 16)

    def once(p):
        left, right = divmod(p, b)
        for k in range(6):
            if k % 2 == 0:
                left = (left + digest(right, k)) % a
            else:
                right = (right + digest(left, k)) % b
        return left * b + right

    crc = lambda t: zlib.crc32((t or "").encode())
    order = sorted(rows, key=lambda r: (hashlib.md5(f"{'' if r[0] is None else r[0]}:{crc(r[1])}".encode()).hexdigest(), len((r[1] or "").encode())))
    out = []
    for p, (i, _) in enumerate(order):
        p = once(p)
        while p >= n:
            p = once(p)
        out.append((i, p % shards, p // shards))
    return out


WORD = re.compile("[A-Za-z0-9\u0080-\U0010ffff]+")


def spans_removed(texts, run=3, least=12, passage=51):
    """{id: text} of the texts that lose repeated runs of sentences or passages of `passage` words; texts by id."""
    seen_runs, seen_words, out = set(), set(), {}
    for i, text in sorted(texts.items()):
        text = text or ""
        at = [m.span() for m in WORD.finditer(text)]
        words = [text[s:e].lower() if text[s:e].isascii() else "".join(c.lower() if c.isascii() else c for c in text[s:e]) for s, e in at]
        ends = [k for k in range(1, len(at)) if re.search(r"\n|[.!?][ \t\n]", text[at[k - 1][1] : at[k][0]])]
        edges = [0, *ends, len(words)] if words else []
        gone = [False] * len(words)
        for x in range(len(edges) - 1):
            y = next((y for y in range(x + run, len(edges)) if edges[y] - edges[x] >= least), None)
            if y is not None:
                key = tuple(words[edges[x] : edges[y]])
                if key in seen_runs:
                    gone[edges[x] : edges[y]] = [True] * (edges[y] - edges[x])
                seen_runs.add(key)
        again = [False] * len(words)
        for x in range(len(words) - least + 1):
            key = tuple(words[x : x + least])
            if key in seen_words:
                again[x : x + least] = [True] * least
            seen_words.add(key)
        x = 0
        while x < len(words):
            y = x
            while y < len(words) and again[y]:
                y += 1
            if y - x >= passage:
                gone[x:y] = [True] * (y - x)
            x = y + 1
        if any(gone):
            starts = [s for s, _ in at] + [len(text)]
            kept = text[: starts[0]] + "".join(text[starts[k] : starts[k + 1]] for k in range(len(words)) if not gone[k])
            out[i] = kept
    return out


def trust(edges, rounds=3, support=3, least=0.6):
    """{(pattern, kind): trust} of (pattern, kind, instance, seed) edges."""
    seeds = {(k, i) for _, k, i, s in edges if s}
    known = dict.fromkeys(seeds, 1.0)
    patterns = {}
    for _ in range(rounds):
        held = defaultdict(list)
        for p, k, i, _ in edges:
            held[p, k].append(known.get((k, i), 0.0))
        patterns = {x: sum(v) / len(v) for x, v in held.items() if sum(v) >= support and sum(v) / len(v) >= least}
        known = dict.fromkeys(seeds, 1.0)
        for p, k, i, s in edges:
            if not s and (p, k) in patterns:
                known[k, i] = max(known.get((k, i), 0.0), patterns[p, k])
    return patterns
