"""Plain Python versions of the contracts, for small fixtures."""
import collections
import hashlib
import re

WORD = re.compile(r"[^\x20\x09-\x0D]+")
UP = {i: i + 32 for i in range(65, 91)}


def base_quality(text):
    t = text or ""
    w = WORD.findall(t)
    tri = [tuple(w[i:i + 3]) for i in range(len(w) - 2)]
    n = collections.Counter(tri)
    covered = {j for i, x in enumerate(tri) if n[x] > 1 for j in (i, i + 1, i + 2)}
    seen, dup = set(), 0
    for line in t.split("\n"):
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    failed = len(w) < 50 or 100 * len(covered) > 50 * len(w)
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), dup, len(covered), failed


def contamination(docs, items):
    word = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    windows = []
    for item_id, text in items:
        w = word.findall((text or "").translate(UP))
        n = min(13, len(w))
        windows += [(item_id, tuple(w[i:i + n])) for i in range(len(w) - n + 1) if n]
    for doc_id, text in docs:
        w = word.findall((text or "").translate(UP))
        hit, found = set(), set()
        for item_id, x in windows:
            for i in range(len(w) - len(x) + 1):
                if tuple(w[i:i + len(x)]) == x:
                    hit.update(range(i, i + len(x)))
                    found.add(str(item_id))
        yield (doc_id, len(w), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(),
               len(hit) > 0 and 20 * len(hit) >= len(w))


def luhn(d):
    return sum(x if i % 2 == 0 else (2 * x - 9 if x > 4 else 2 * x) for i, x in enumerate(map(int, reversed(d)))) % 10 == 0


def pii(text):
    t, out = text or "", []
    for kind, pattern, ok in (
            ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda m: True),
            ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda m: all(int(x) <= 255 for x in m.split("."))),
            ("card", r"[0-9]([\x20-]?[0-9])+", lambda m: 13 <= len(d := re.sub("[^0-9]", "", m)) <= 19 and luhn(d)),
            ("phone", r"\+[0-9][\x20().0-9-]+[0-9]", lambda m: 9 <= len(re.sub("[^0-9]", "", m)) <= 15)):
        out += [(kind, m.start(), m.end()) for m in re.finditer(pattern, t) if ok(m[0])]
    return out


def simhash(text):
    import xxhash
    w = [x.translate(UP) for x in WORD.findall(text or "")]
    s = [" ".join(w[i:i + 4]) for i in range(len(w) - 3)] or ([" ".join(w)] if w else [])
    h = [xxhash.xxh64_intdigest(x.encode(), 42) for x in s]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def components(ids, fps, radius=4):
    up = list(range(len(ids)))

    def top(i):
        while up[i] != i:
            i = up[i]
        return i
    for i in range(len(ids)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= radius:
                up[top(i)] = top(j)
    least = {}
    for i, x in enumerate(ids):
        if x is not None:
            least[top(i)] = min(x, least.get(top(i), x))
    return [least.get(top(i)) for i in range(len(ids))]


def targets(sizes):
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    w = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    free, total = set(names), sum(sizes.values())
    while True:
        rest = total - sum(3 * sizes[s] for s in names if s not in free)
        level = rest / (sum(w[s] for s in free) or 1)
        over = {s for s in free if level * w[s] > 3 * sizes[s] * (1 + 1e-12)}
        if not over:
            return {s: level * w[s] if s in free else 3 * sizes[s] for s in names}
        free -= over
