"""Plain Python versions of the operators' contracts, for small tables."""

from __future__ import annotations

import hashlib
import re
import zlib
from collections import Counter, defaultdict
from itertools import permutations

import xxhash

PLAIN = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
BLANK = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain_words(text):
    return PLAIN.findall((text or "").translate(LOWER))


def blank_words(text):
    return BLANK.findall(text or "")


def url_parts(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    host = re.match(r"[^/?#]*", rest).group(0)
    path = re.match(r"[^?#]*", rest[len(host):]).group(0)
    return host.translate(LOWER), path


def url_rule(host, path, rules):
    fits = [(len(r), r, v) for v, r in rules
            if (host == r.split("/")[0] or host.endswith("." + r.split("/")[0]))
            and path.startswith("/" + r.partition("/")[2])]
    return max(fits)[1:] if fits else None


def licenses(text, phrases):
    words = plain_words(text)
    starts, labels = [], set()
    for phrase, label in phrases.items():
        p = phrase.split()
        for i in range(len(words) - len(p) + 1):
            if words[i:i + len(p)] == p:
                starts.append(i)
                labels.add(label)
    return (len(words), len(starts), min(starts, default=None), max(starts, default=None),
            ",".join(sorted(labels)))


def quality(text):
    words = blank_words(text)
    windows = [tuple(words[i:i + 8]) for i in range(len(words) - 7)]
    count = Counter(windows)
    inside = {j for i, w in enumerate(windows) if count[w] > 1 for j in range(i, i + 8)}
    seen, dup = set(), 0
    for line in (text or "").split("\n"):
        if BLANK.search(line):
            dup += line in seen
            seen.add(line)
    n = len(words)
    return (n, sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")), dup, len(inside),
            n < 20 or 100 * len(inside) > 30 * n)


def record(text):
    data = (text or "").encode()
    return len(data) + 16, zlib.crc32(data)


def contamination(docs, items, window=13):
    windows = defaultdict(set)
    for item, text in items:
        words = plain_words(text)
        if not words:
            continue
        for i in range(max(1, len(words) - window + 1)):
            windows[tuple(words[i:i + window])].add(str(item))
    sizes = sorted({len(w) for w in windows})
    out = []
    for doc, text in docs:
        words, hit, found = plain_words(text), set(), set()
        for size in sizes:
            for i in range(len(words) - size + 1):
                w = tuple(words[i:i + size])
                if w in windows:
                    found |= windows[w]
                    hit.update(range(i, i + size))
        out.append((doc, len(words), len(hit), len(found),
                    hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(),
                    len(hit) > 0 and 20 * len(hit) >= len(words)))
    return out


def near_duplicates(docs, k=5):
    sets = {}
    for doc, text in docs:
        words = blank_words((text or "").translate(LOWER))
        sets[doc] = ({tuple(words[i:i + k]) for i in range(len(words) - k + 1)} if len(words) >= k
                     else {tuple(words)} if words else set())
    shared = Counter()
    where = defaultdict(list)
    for doc, s in sets.items():
        for x in s:
            where[x].append(doc)
    for holders in where.values():
        for i, a in enumerate(holders):
            for b in holders[i + 1:]:
                shared[a, b] += 1
    parent = {d: d for d in sets}

    def root(d):
        while parent[d] != d:
            parent[d] = parent[parent[d]]
            d = parent[d]
        return d

    for (a, b), both in shared.items():
        if 100 * both >= 75 * (len(sets[a]) + len(sets[b]) - both):
            x, y = sorted((root(a), root(b)))
            parent[y] = x
    return [(d, len(s), root(d)) for d, s in sets.items()]


def suffix_dedup(docs, span=100):
    seen, out = set(), []
    for doc, text in sorted(docs, key=lambda x: x[0]):
        data = (text or "").encode()
        gone = bytearray(len(data))
        for i in range(len(data) - span + 1):
            s = hash(data[i:i + span])
            if s in seen:
                gone[i:i + span] = b"\x01" * span
            else:
                seen.add(s)
        kept = bytes(b for b, g in zip(data, gone) if not g)
        runs = sum(1 for i, g in enumerate(gone) if g and (not i or not gone[i - 1]))
        out.append((doc, len(data), sum(gone), runs, hashlib.sha256(kept).hexdigest()))
    return out


def water_fill(children, budget):
    """children: name -> (weight, capacity); whole tokens for each."""
    budget = min(budget, sum(c for _, c in children.values()))
    out, rest, live = {}, budget, dict(children)
    for name in sorted(live, key=lambda n: (live[n][1] / live[n][0] if live[n][0] else 0.0, n)):
        weight, cap = live[name]
        total = sum(w for w, _ in live.values())
        if cap * total <= weight * rest:
            out[name] = cap
            rest -= cap
            del live[name]
        else:
            break
    total = sum(w for w, _ in live.values())
    for name, (weight, _) in live.items():
        out[name] = weight * rest // total if total else 0
    return out


def mixture(docs, weights, seed, share=1.0, epochs=1):
    """docs: (doc_id, tokens, (levels...)); weights: one function per level."""
    def budgets(rows, depth, given):
        if depth == len(weights):
            return {(): given}
        groups = defaultdict(list)
        for r in rows:
            groups[r[2][depth]].append(r)
        children = {}
        for name, part in groups.items():
            cap = sum(r[1] for r in part) * epochs
            children[name] = (weights[depth](name), cap)
        out = {}
        for name, b in water_fill(children, given).items():
            for path, x in budgets(groups[name], depth + 1, b).items():
                out[(name, *path)] = x
        return out

    total = int(sum(r[1] for r in docs) * share)
    taken = []
    for leaf, budget in budgets(docs, 0, total).items():
        rows = [r for r in docs if r[2] == leaf]
        size = sum(r[1] for r in rows)
        full = budget // size if size else 0
        rest = budget - full * size
        place = {r[0]: hashlib.md5(f"{seed}:{full}:{r[0]}".encode()).hexdigest() for r in rows}
        for e in range(full):
            taken += [(r[0], e) for r in rows]
        for r in sorted(rows, key=lambda r: place[r[0]]):
            rest -= r[1]
            if rest < 0:
                break
            taken.append((r[0], full))
    return taken


def simhash(text, k=3):
    words = blank_words((text or "").translate(LOWER))
    grams = [" ".join(words[i:i + k]) for i in range(max(1, len(words) - k + 1))] if words else []
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def simhash_groups(docs, reach=2):
    """docs: (doc_id, text); (doc_id, fingerprint, component_id) of each."""
    prints = [(d, simhash(t)) for d, t in docs]
    codes = sorted({f for _, f in prints})
    parent = {f: f for f in codes}

    def root(f):
        while parent[f] != f:
            f = parent[f]
        return f

    for i, a in enumerate(codes):
        for b in codes[i + 1:]:
            if (a ^ b).bit_count() <= reach:
                parent[root(b)] = root(a)
    low = {}
    for d, f in prints:
        low[root(f)] = min(d, low.get(root(f), d))
    return [(d, f"{f:016x}", low[root(f)]) for d, f in prints]


LETTERS = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")


def source_audit(docs, least=30, top=50):
    """docs: (text, lang, source); rows of both parts."""
    rows = [(LETTERS.findall((t or "").translate(LOWER)), lang or "", source or "")
            for t, lang, source in docs]
    out = []
    for lang in {r[1] for r in rows}:
        here = [r for r in rows if r[1] == lang]
        held = Counter(x for words, _, _ in here for x in set(words))
        kept = {x for x, n in held.items() if n >= least}
        counts = {s: Counter() for _, _, s in here}
        for words, _, s in here:
            counts[s].update(x for x in words if x in kept)
        whole = sum(counts.values(), Counter())

        def shares(c):
            below = sum(c.values()) + 5 * len(kept)
            return {x: 1 + 10**9 * (c[x] + 5) // below for x in kept}
        p, q = {s: shares(c) for s, c in counts.items()}, shares(whole)
        for s in counts:
            pairs = [(-sum(abs(p[s][x] - p[o][x]) for x in kept), o.encode()) for o in counts if o != s]
            terms = [(q[x] - p[s][x], x.encode()) for x in kept if counts[s][x] and p[s][x] > q[x]]
            for part, found in (("pair", sorted(pairs)), ("term", sorted(terms)[:top])):
                out += [(lang, s, part, item.decode(), -value, rank)
                        for rank, (value, item) in enumerate(found, 1)]
    return out


def filter_audit(docs, labels):
    """docs: (doc_id, text, part); labels: (doc_id, quality, toxic)."""
    good = {d for d, q, _ in labels if q == 1 and d is not None}
    toxic = {d for d, _, t in labels if t == 1 and d is not None}
    fails = []
    for d, text, part in docs:
        t = text or ""
        w = blank_words(t)
        fails.append((part or "", d, {x for x, bad in (
            ("A", len(w) < 200), ("B", 100 * len(set(w)) < 50 * len(w)),
            ("C", 100 * len(re.findall("[A-Z]", t)) > 3 * len(t)),
            ("D", bool(re.search(r"[#$%&*|]", t))),
            ("E", d is not None and any(o is not None and o < d and (x or "") == t
                                        for o, x, _ in docs))) if bad}))
    out = []
    for part in {p for p, _, _ in fails}:
        here = [(d, f) for p, d, f in fails if p == part]
        shapley = Counter()
        rows = []
        for order in permutations("ABCDE"):
            left = here
            for step, letter in enumerate(order, 1):
                gone = [x for x in left if letter in x[1]]
                left = [x for x in left if letter not in x[1]]
                failing = sum(letter in f for _, f in here)
                shapley[letter] += len(gone)
                rows.append((part, "".join(order), step, len(left), len(gone), failing - len(gone),
                             sum(f == {letter} for _, f in here), sum(d in good for d, _ in gone),
                             sum(d in toxic for d, _ in gone), letter))
        out += [(*r[:-1], shapley[r[-1]]) for r in rows]
    return out


def surge_and_dive(lines, window=3):
    """Main lines of (text, weight, in article): a line with weight is main when
    some line with weight at or before it, of its run, surges and no window of
    lines from there to it weighs nothing."""
    if not any(w and any(c.isalnum() for c in t) for t, w, _ in lines):
        return []
    run_of, runs = [], -1
    for i, line in enumerate(lines):
        runs += i == 0 or line[2] != lines[i - 1][2]
        run_of.append(runs)
    total = [sum(lines[j][1] for j in range(i, min(i + window, len(lines))) if run_of[j] == run_of[i])
             for i in range(len(lines))]
    heaviest = max(total)
    article = any(x[2] for x in lines)
    bound = max(80, heaviest / 2) if article else min(80, heaviest / 4)
    surges = [w > 0 and (inside or total[i] >= bound) for i, (_, w, inside) in enumerate(lines)]
    return [lines[i][0] for i in range(len(lines)) if lines[i][1] and any(
        surges[j] and run_of[j] == run_of[i] and (lines[i][2] or all(total[j:i + 1]))
        for j in range(i + 1))]
