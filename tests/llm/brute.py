"""Plain versions of the operators over lists of rows, as slow and as simple as can be."""

import base64
import hashlib
import re
from collections import defaultdict

import xxhash

KINDS = [
    ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"),
    ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
    ("card", r"[0-9]([\x20-]?[0-9])+"),
    ("phone", r"\+[0-9][\x20().0-9-]+[0-9]"),
]


def sha(value):
    return hashlib.sha256(value if isinstance(value, bytes) else value.encode()).hexdigest()


def lower(text):
    return re.sub("[A-Z]+", lambda m: m[0].lower(), text or "")


def words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower(text))


def phrases(docs, base):
    out = []
    for doc_id, text in docs:
        own, hits = words(text), []
        for phrase, label in base.items():
            p = phrase.split()
            hits += [(k, label) for k in range(len(own) - len(p) + 1) if own[k : k + len(p)] == p]
        starts = [k for k, _ in hits]
        labels = ",".join(sorted({x for _, x in hits}))
        out.append((doc_id, len(own), len(hits), min(starts, default=None), max(starts, default=None), labels))
    return out


def edited(docs):
    ring = sorted(docs, key=lambda r: (-r[0], r[1] or ""))
    out = []
    for k, (doc_id, text) in enumerate(ring):
        text, after = text or "", ring[(k + 1) % len(ring)][1] or ""
        half = len(text) // 2
        out.append((doc_id, len(text), sha(text[: len(text) - half] + after[:half])))
    return out


def simhash(text, size=3):
    own = lower(text).encode().split()
    shingles = [b" ".join(own[k : k + size]) for k in range(len(own) - size + 1)] or [b" ".join(own)] * bool(own)
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def groups(marks, radius):
    """(id, mark, smallest id of its component) of (id, mark) rows."""
    root = {m: m for _, m in marks}

    def find(m):
        while root[m] != m:
            m = root[m]
        return m

    distinct = sorted(root)
    for k, a in enumerate(distinct):
        for b in distinct[:k]:
            if (a ^ b).bit_count() <= radius:
                root[find(a)] = find(b)
    first = {}
    for i, m in marks:
        first[find(m)] = min(first.get(find(m), i), i)
    return [(i, m, first[find(m)]) for i, m in marks]


def near_groups(docs, size=5, similarity=0.8):
    """Smallest id of the component of every id: equal words, or sets of word runs of at least this Jaccard similarity."""
    sets = {}
    for i, text in docs:
        own = lower(text).encode().split()
        sets[i] = frozenset(tuple(own[k : k + size]) for k in range(max(1, len(own) - size + 1)))
    root = {i: i for i in sets}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    ids = sorted(sets)
    for k, a in enumerate(ids):
        for b in ids[:k]:
            shared = len(sets[a] & sets[b])
            if shared and shared >= similarity * (len(sets[a]) + len(sets[b]) - shared):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {i: find(i) for i in ids}


def archive(pages):
    top = {}
    for page_id, html in pages:
        top[html or ""] = max(page_id, top.get(html or "", page_id))
    out = []
    for page_id, html in pages:
        raw, first = (html or "").encode(), top[html or ""]
        digest = base64.b32encode(hashlib.sha1(raw).digest()).decode()
        same = first == page_id
        out.append((page_id, len(raw), digest, "response" if same else "revisit", None if same else first))
    return out


def chats(rows):
    own = defaultdict(list)
    for conv_id, turn, role, text in rows:
        own[conv_id].append((turn, role or "", text or ""))
    out = []
    for conv_id, turns in own.items():
        turns.sort()
        loss = "".join(t for _, r, t in turns if r == "assistant")
        said = "".join(f"{r}\n{t}\n" for _, r, t in turns)
        out.append((conv_id, len(turns), sha(said), len(loss), sha(loss)))
    return out


def repeats(docs, length=100):
    """Rows in order of id; ids differ."""
    seen, out = set(), []
    for doc_id, text in docs:
        raw = (text or "").encode()
        gone = bytearray(len(raw))
        for p in range(len(raw) - length + 1):
            if raw[p : p + length] in seen:
                gone[p : p + length] = b"\1" * length
            seen.add(raw[p : p + length])
        kept = bytes(b for b, g in zip(raw, gone) if not g)
        spans = sum(1 for p in range(len(gone)) if gone[p] and (p == 0 or not gone[p - 1]))
        out.append((doc_id, len(raw), sum(gone), spans, sha(kept)))
    return out


def contaminated(docs, items, size=13):
    windows = defaultdict(set)
    for item_id, text in items:
        own = words(text)
        n = min(size, len(own))
        for k in range(len(own) - n + 1) if n else ():
            windows[tuple(own[k : k + n])].add(str(item_id))
    sizes, out = {len(w) for w in windows}, []
    for doc_id, text in docs:
        own, hit, found = words(text), set(), set()
        for n in sizes:
            for k in range(len(own) - n + 1):
                held = windows.get(tuple(own[k : k + n]))
                if held:
                    hit.update(range(k, k + n))
                    found |= held
        bad = bool(hit) and 20 * len(hit) >= len(own)
        out.append((doc_id, len(own), len(hit), len(found), sha(",".join(sorted(found))), bad))
    return out


def luhn(digits):
    total = 0
    for k, d in enumerate(reversed(digits)):
        n = int(d) * 2 if k % 2 else int(d)
        total += n // 10 + n % 10
    return total % 10 == 0


def personal(docs):
    out = []
    for doc_id, text in docs:
        found, counts = [], []
        for k, (kind, pattern) in enumerate(KINDS):
            own = []
            for m in re.finditer(pattern, text or ""):
                digits = re.sub("[^0-9]", "", m[0])
                right = {
                    "email": lambda: True,
                    "ip": lambda: all(int(p) <= 255 for p in m[0].split(".")),  # noqa: B023
                    "card": lambda: 12 <= len(digits) <= 19 and luhn(digits),  # noqa: B023
                    "phone": lambda: 9 <= len(digits) <= 15,  # noqa: B023
                }[kind]
                if right():
                    own.append((m.start(), k, f"{kind}:{m.start()}:{m.end()}"))
            counts.append(len(own))
            found += own
        out.append((doc_id, *counts, sha(",".join(x[2] for x in sorted(found)))))
    return out
