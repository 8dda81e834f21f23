"""Plain Python models that the operators are held against."""

import hashlib
import math
import re
import zlib


def blank_words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def fold(text):
    return re.sub(r"[A-Z]", lambda m: m[0].lower(), text or "")


def statistics(text):
    text = text or ""
    words = blank_words(text)
    lines = [x for x in text.split("\n") if blank_words(x)]
    windows = [tuple(words[i:i + 3]) for i in range(len(words) - 2)]
    often = {w for w in windows if windows.count(w) > 1}
    covered = {i + k for i, w in enumerate(windows) if w in often for k in range(3)}
    return (len(words), sum(map(len, words)), sum(text.count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)), len(covered))


def shingles(text, n):
    words = blank_words(fold(text))
    return frozenset(tuple(words[i:i + n]) for i in range(max(1, len(words) - n + 1))) if words else frozenset()


def components(rows, n, percent):
    """{row: smallest id reachable} of (doc_id, text) rows, by all pairs."""
    sets = [shingles(t, n) for _, t in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= percent * len(sets[i] | sets[j]):
                root[max(find(i), find(j))] = min(find(i), find(j))
    groups = {}
    for i in range(len(rows)):
        groups.setdefault(find(i), []).append(i)
    low = {k: min((rows[i][0] for i in g if rows[i][0] is not None), default=None) for k, g in groups.items()}
    return [(rows[i][0], len(sets[i]), low[find(i)] if sets[i] else rows[i][0]) for i in range(len(rows))]


def benchmark_words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", fold(text))


def contamination(text, items, size=13, share=20):
    words = benchmark_words(text)
    hit, found = set(), set()
    for item, body in items:
        own = benchmark_words(body)
        for s in range(max(1, len(own) - size + 1) if own else 0):
            w = own[s:s + size]
            for i in range(len(words) - len(w) + 1):
                if words[i:i + len(w)] == w:
                    hit |= set(range(i, i + len(w)))
                    if item is not None:
                        found.add(str(item))
    return (len(words), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(),
            bool(hit) and share * len(hit) >= len(words))


def near_items(text, items, slop):
    """Items with all their words within their number of distinct words plus ``slop`` words of the text."""
    words, found = benchmark_words(text), set()
    for item, body in items:
        need = set(benchmark_words(body))
        if item is not None and need and any(need <= set(words[i:i + len(need) + slop]) for i in range(len(words))):
            found.add(item)
    return len(found)


def targets(sizes, weights=(5, 2, 1), share=1.5, cap=2):
    """{source: target} by refilling until none is above."""
    names = sorted((s for s in sizes if s is not None)) + ([None] if None in sizes else [])
    w = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    total, full = share * sum(sizes.values()), set()
    while True:
        free = [s for s in names if s not in full]
        left = total - sum(cap * sizes[s] for s in full)
        want = {s: left * w[s] / sum(w[x] for x in free) for s in free}
        over = {s for s in free if want[s] > cap * sizes[s] + 1e-9}
        if not over:
            return {**want, **{s: cap * sizes[s] for s in full}}
        full |= over


def rebuilt_conversations(rows):
    own = {}
    for c, t, role, text in rows:
        if c is not None:
            own.setdefault(c, []).append((t is not None, t or 0, role or "", text or ""))
    turns = {c: [x[2:] for x in sorted(v)] for c, v in own.items()}
    out = {}
    for c in turns:
        h, base = zlib.crc32(str(c).encode()) % 4, c - int(math.fmod(c, 20))
        out[c] = turns.get(base, [])[:h] + turns[c][h:]
    return out


def prefix_trie(rows):
    conv = rebuilt_conversations(rows)
    members, children, leaves, saved = {}, {}, {}, {}
    for c in sorted(conv):
        for d in range(len(conv[c]) + 1):
            members.setdefault(tuple(conv[c][:d]), []).append(c)
    for n in members:
        if n:
            children.setdefault(n[:-1], []).append(n)
    for n in sorted(members, key=len, reverse=True):
        below = children.get(n, [])
        leaves[n] = sum(leaves[k] for k in below) if below else 1
        saved[n] = (len(members[n]) - 1) * (len(blank_words(n[-1][1])) if n else 0) + sum(saved[k] for k in below)
    ends = lambda n: ",".join(str(c) for c in members[n] if len(conv[c]) == len(n))
    return [(m[0], len(n), members[n[:-1]][0] if n else None, len(m), len(children.get(n, [])), leaves[n], saved[n],
             hashlib.sha256(ends(n).encode()).hexdigest()) for n, m in members.items()]


def spelling(rows, least=7, often=2):
    counts = {}
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = fold(run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 31 == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            counts[run] = counts.get(run, 0) + 1
    words = {w: n for w, n in counts.items() if len(w) >= least and n >= often}
    near = {w: [x for x in words if one_letter_apart(w, x)] for w in words}
    form = {}
    for w in words:
        best = min(near[w], key=lambda x: (-words[x], x), default=None)
        form[w] = best if best and words[best] >= 10 * words[w] else None

    def root(w):
        return root(form[w]) if form[w] else w

    return [(w, form[w], root(w), n, len(near[w]), words.get(form[w])) for w, n in words.items()]


def one_letter_apart(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def clause_scores(words, insults, threats, classes, reach=3):
    """(insult, threat) score of a clause, each word weighed by what stands around it."""
    own = [("threat" if w in threats else "insult" if w in insults else classes.get(w)) for w in words]
    insult = threat = 0.0
    for i, (w, c) in enumerate(zip(words, own)):
        factor = 0.25 if "negation" in own[max(0, i - reach):i] else 1.0
        factor *= 0.5 if "report" in own[:i] else 1.0
        if c == "insult":
            run = 0  # insults directly before
            while run < i and own[i - run - 1] == "insult":
                run += 1
            insult += insults[w] * factor * (1.25 if run else 1.0) * (1.5 if "target" in own else 1.0)
        elif c == "threat":
            threat += threats[w] * factor * (1.0 if "intent" in own[max(0, i - reach):i] else 0.3) * (1.0 if "target" in own else 0.2)
    return insult, threat
