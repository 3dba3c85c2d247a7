"""Plain versions of the operators, on lists of ``(doc_id, text)``."""

import hashlib
import re
from collections import Counter

import xxhash

BLANK = " \t\n\x0b\x0c\r"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def ascii_lower(text):
    return "".join(chr(ord(ch) + 32) if "A" <= ch <= "Z" else ch for ch in text)


def words(text):
    return WORD.findall(text or "")


def joined(docs, width, percent):
    """``doc_id, n, component, links`` for each row."""
    sets = []
    for _, text in docs:
        w = words(ascii_lower(text or ""))
        grams = [tuple(w[i : i + width]) for i in range(len(w) - width + 1)] or ([tuple(w)] if w else [])
        sets.append(set(grams))
    up = list(range(len(docs)))
    links = [0] * len(docs)

    def root(i):
        while up[i] != i:
            i = up[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and 100 * len(a & b) >= percent * len(a | b):
                links[i] += 1
                links[j] += 1
                up[root(i)] = root(j)
    low = {}
    for i, (doc_id, _) in enumerate(docs):
        low[root(i)] = min(low.get(root(i), doc_id), doc_id)
    return [(d, len(sets[i]), low[root(i)], links[i]) for i, (d, _) in enumerate(docs)]


def line_key(line):
    return ascii_lower(line.strip(BLANK))


def kept_lines(docs, least):
    counts = Counter(k for _, t in docs for k in {line_key(x) for x in (t or "").split("\n")} if k)
    out = []
    for doc_id, text in docs:
        lines = (text or "").split("\n")
        out.append((doc_id, lines, [x for x in lines if counts[line_key(x)] < least]))
    return out


def base_counts(text):
    text = text or ""
    w = words(text)
    seen = Counter(tuple(w[i : i + 8]) for i in range(len(w) - 7))
    covered = set()
    for i in range(len(w) - 7):
        if seen[tuple(w[i : i + 8])] > 1:
            covered.update(range(i, i + 8))
    lines = [x for x in text.split("\n") if words(x)]
    dup = sum(x in lines[:i] for i, x in enumerate(lines))
    return len(w), sum(map(len, w)), sum(ch in "#*$%&|<>" for ch in text), dup, len(covered)


def winnow(text, gram, window, prime, base):
    """``(hash, position)`` of each chosen hash, in order."""
    h = [xxhash.xxh64_intdigest(w.encode(), 42) for w in WORD.findall((text or "").lower())]
    h = [(x - 2**64 if x >= 2**63 else x) % prime for x in h]
    grams = [h[i : i + gram] for i in range(len(h) - gram + 1)] or ([h] if h else [])
    rolled = []
    for g in grams:
        value = 0
        for x in g:
            value = (value * base + x) % prime
        rolled.append(value)
    chosen = []
    for i in range(max(len(rolled) - window + 1, min(len(rolled), 1))):
        part = rolled[i : i + window]
        at = max(k for k, x in enumerate(part) if x == min(part))
        if (part[at], i + at) not in chosen:
            chosen.append((part[at], i + at))
    return chosen


def sentences(text):
    parts = re.findall(r"[^.!?\n]*[.!?\n]+|[^.!?\n]+", text or "")
    out = []
    for part in parts:
        w = words(ascii_lower(part).rstrip(".!?\n"))
        if w or not out:
            out.append([part, w])
        else:
            out[-1][0] += part
    return out


def spans(docs, least_sentences, least_words):
    """``doc_id, sentences, removed, hash of what is kept`` for each row.

    A sentence goes if it lies in a stretch, long enough, that occurs before it as it is: all stretches that
    two places share are found by walking both.
    """
    found = [sentences(t) for _, t in docs]
    places = [(doc_id, i, d) for d, (doc_id, _) in enumerate(docs) for i in range(len(found[d]))]
    places.sort(key=lambda p: p[:2])
    by_text, gone, walked = {}, set(), set()
    for place in places:
        by_text.setdefault(tuple(found[place[2]][place[1]][1]), []).append(place)
    for own in by_text.values():
        for k, (_, i, d) in enumerate(own):
            for _, j, e in own[:k]:
                if (d, i, e, j) in walked:
                    continue
                n = 0
                while i + n < len(found[d]) and j + n < len(found[e]) and found[d][i + n][1] == found[e][j + n][1]:
                    walked.add((d, i + n, e, j + n))
                    n += 1
                back = 0
                while i > back and j > back and found[d][i - back - 1][1] == found[e][j - back - 1][1]:
                    back += 1
                stretch = range(i - back, i + n)
                if len(stretch) >= least_sentences and sum(len(found[d][s][1]) for s in stretch) >= least_words:
                    gone.update((d, s) for s in stretch)
    out = []
    for d, (doc_id, _) in enumerate(docs):
        kept = "".join(s[0] for k, s in enumerate(found[d]) if (d, k) not in gone)
        removed = sum((d, k) in gone for k in range(len(found[d])))
        out.append((doc_id, len(found[d]), removed, hashlib.sha256(kept.encode()).hexdigest()))
    return out


def shared_out(given, nodes):
    """Budgets of ``{name: (weight, capacity)}``: shortages are met among siblings."""
    nodes = {k: v for k, v in nodes.items() if v[0] > 0}
    out, left, free = {}, given, dict(nodes)
    while True:
        total = sum(w for w, _ in free.values())
        short = [k for k, (w, c) in free.items() if c * total <= w * left]
        if not short:
            break
        for k in sorted(short, key=lambda k: (free[k][1] / free[k][0], k))[:1]:
            out[k] = free.pop(k)[1]
            left -= out[k]
    if free:
        total = sum(w for w, _ in free.values())
        for k, (w, _) in free.items():
            out[k] = w * left // total
        over = left - sum(out[k] for k in free)
        for k in sorted(free, key=lambda k: (-(free[k][0] * left % total), k))[:over]:
            out[k] += 1
    return out


def mixed(rows, weights, epochs, share, seed):
    """``doc_id, times`` of rows ``(doc_id, text, lang, source)``: the tree of two levels walked leaf by leaf."""
    leaves = {}
    for r in rows:
        leaves.setdefault((r[2] or "", r[3] or ""), []).append((r[0], len(words(r[1]))))
    weight = lambda level, name: weights[level].get(name, 1)
    usable = {k: weight("lang", k[0]) > 0 and weight("source", k[1]) > 0 for k in leaves}
    tokens = {k: sum(n for _, n in own) for k, own in leaves.items()}
    room = lambda keys: epochs * sum(tokens[k] for k in keys if usable[k])
    langs = {k[0]: (weight("lang", k[0]), room([q for q in leaves if q[0] == k[0]])) for k in leaves}
    budget = dict.fromkeys(leaves, 0)
    for lang, given in shared_out(int(sum(tokens.values()) * share), langs).items():
        own = {k[1]: (weight("source", k[1]), room([k])) for k in leaves if k[0] == lang}
        budget |= {(lang, s): b for s, b in shared_out(given, own).items()}
    times, spare, following = {}, {}, {}
    for k, own in leaves.items():
        full, rest = divmod(budget[k], tokens[k]) if tokens[k] else (0, 0)
        by_key = {}
        for doc_id, n in own:
            by_key.setdefault(hashlib.md5(f"{seed}:{full}:{doc_id}".encode()).hexdigest(), []).append((doc_id, n))
        times |= {(k, doc_id): full for doc_id, _ in own}
        if not usable[k]:
            continue
        spare[k] = rest
        for _, docs in sorted(by_key.items()):
            size = sum(n for _, n in docs)
            if size > spare[k]:
                if full < epochs:
                    following[k] = (size, docs)
                break
            spare[k] -= size
            times |= {(k, d): full + 1 for d, _ in docs}
    for family in (lambda k: k[0], lambda k: None):
        for name in {family(k) for k in leaves}:
            pool = sum(n for k, n in spare.items() if family(k) == name)
            for k in sorted((k for k in following if family(k) == name), key=lambda k: (following[k][0], k)):
                size, docs = following[k]
                if size > pool:
                    break
                pool -= size
                spare[k] -= size
                times |= {(k, d): times[k, d] + 1 for d, _ in docs}
                del following[k]
    return Counter((r[0], times[(r[2] or "", r[3] or ""), r[0]]) for r in rows)
