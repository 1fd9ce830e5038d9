"""Plain versions of what the operators compute, for small tables."""

import math
import re
import zlib
from collections import Counter, defaultdict

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def words(text):
    return WORD.findall(text or "")


def lower_ascii(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def components(n, links):
    up = list(range(n))

    def find(x):
        while up[x] != x:
            up[x] = up[up[x]]
            x = up[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        up[max(a, b)] = min(a, b)
    return [find(x) for x in range(n)]


def least_ids(ids, links):
    of = components(len(ids), links)
    least = defaultdict(lambda: math.inf)
    for i, c in enumerate(of):
        if ids[i] is not None:
            least[c] = min(least[c], ids[i])
    return [least[c] if least[c] < math.inf else None for c in of]


def shingles(text):
    w = words(lower_ascii(text or ""))
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set()


def near(texts, percent=85):
    sets = [shingles(t) for t in texts]
    links = []
    for i in range(len(sets)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if sets[i] and sets[j] and 100 * both >= percent * (len(sets[i]) + len(sets[j]) - both):
                links.append((j, i))
    return sets, links


def quality_base(text):
    text = text or ""
    w = words(text)
    windows = Counter(zip(w, w[1:], w[2:]))
    hit = set()
    for i in range(len(w) - 2):
        if windows[tuple(w[i : i + 3])] > 1:
            hit |= {i, i + 1, i + 2}
    seen, dup = set(), 0
    for line in text.split("\n"):
        if words(line):
            dup += line in seen
            seen.add(line)
    return len(w), sum(map(len, w)), sum(text.count(c) for c in "#*$%&|<>"), dup, len(hit)


def jensen_shannon(a, b):
    if not sum(a) or not sum(b):
        return None
    out = 0.0
    for x, y in zip(a, b):
        p, q = x / sum(a), y / sum(b)
        out += sum(v * math.log2(2 * v / (p + q)) for v in (p, q) if v) / 2
    return math.sqrt(max(out, 0.0))


def char_classes(text):
    """Lower case, upper case, digit, white space, stop, other mark, symbol, beyond ASCII."""
    out = [0] * 8
    for c in text or "":
        if ord(c) > 127:
            k = 7
        elif c.isalpha():
            k = int(c.isupper())
        else:
            k = 2 if c.isdigit() else 3 if c in " \t\n\v\f\r" else 4 if c in ".,;:!?'\"()-" else 6 if c in "#*$%&|<>" else 5
        out[k] += 1
    return out


def word_bins(text, listed):
    out = [0] * 32
    for w in words(text):
        w = lower_ascii(w).strip(".,;:!?\"'()")
        out[listed.index(w) if w in listed else 31] += 1
    return out


def divergence(texts, langs, lists):
    """chars_apart, words_apart and kept of each text: the prior, the first and the second sums, and the limits."""
    base = [quality_base(t) for t in texts]
    failed = [n < 50 or 2 * rep > n for n, _, _, _, rep in base]
    chars = [char_classes(t) for t in texts]
    bins = [word_bins(t, lists[g].split()[:31]) if g in lists else [0] * 32 for t, g in zip(texts, langs)]

    def references(rows):
        out = {}
        for lang in {g for g, f in zip(langs, failed) if not f}:
            own = [i for i in rows if langs[i] == lang]
            c = [sum(chars[i][k] for i in own) for k in range(8)]
            b = [sum(bins[i][k] for i in own) for k in range(32)]
            letters = c[0] + c[1] + c[7]
            shares = [x / letters for x in (c[0], c[1], c[7])] if letters else [0.97, 0.03, 0]
            prior = [0.8 * shares[0], 0.8 * shares[1], 0.01, 0.16, 0.025, 0.005, 0, 0.8 * shares[2]]
            ranks = sum(1 / k for k in range(1, 32))
            often = [0.3 / k / ranks for k in range(1, 32)] + [0.7]
            out[lang] = [x + 20000 * p for x, p in zip(c, prior)], [x + 3000 * p for x, p in zip(b, often)] if lang in lists else None
        return out

    def apart(refs, least_words):
        out = []
        for i, g in enumerate(langs):
            c, b = refs.get(g, (None, None))
            out.append((jensen_shannon(chars[i], c) if c and base[i][1] >= 200 else None, jensen_shannon(bins[i], b) if b and base[i][0] >= least_words else None))
        return out

    first = apart(references([i for i, f in enumerate(failed) if not f]), 100)
    near = [i for i, (c, w) in enumerate(first) if not failed[i] and (c or 0) <= 0.30 and (w or 0) <= 0.31]
    return [(c, w, not f and ((c or 0) / 0.30) ** 2 + ((w or 0) / 0.36) ** 2 <= 1) for (c, w), f in zip(apart(references(near), 50), failed)]


def mix_targets(sizes, weights=(5, 2, 1), ratio=1.5, most=2):
    """sizes: source to size."""
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    capped = set()
    while True:
        rest = ratio * sum(sizes.values()) - sum(most * sizes[s] for s in capped)
        total = sum(weight[s] for s in order if s not in capped)
        targets = {s: most * sizes[s] if s in capped else weight[s] * rest / total for s in order}
        new = {s for s in order if s not in capped and targets[s] > most * sizes[s]}
        if not new:
            return targets
        capped |= new


def best_fit(lengths, capacity):
    """Best fit decreasing piece by piece: the remaining capacities of the bins."""
    left = []
    for n in sorted(lengths, reverse=True):
        fits = [(r, i) for i, r in enumerate(left) if r >= n]
        if fits:
            r, i = min(fits)
            left[i] = r - n
        else:
            left.append(capacity - n)
    return sorted(left)


def crc(data):
    return zlib.crc32(data)
