"""Plain single-process versions of the operators, for small fixtures."""

import hashlib
import re
import zlib
from collections import Counter

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def words(text):
    return WORD.findall(text or "")


def ascii_lower(text):
    return (text or "").translate({c: c + 32 for c in range(65, 91)})


def shingle_set(text, k):
    w = words(ascii_lower(text))
    if not w:
        return frozenset()
    if len(w) < k:
        return frozenset([tuple(w)])
    return frozenset(tuple(w[i:i + k]) for i in range(len(w) - k + 1))


def near_duplicates(docs, k, percent):
    """doc_id -> (n_shingles, component_id)."""
    sets = {d: shingle_set(t, k) for d, t in docs}
    root = {d: d for d in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    index = {}
    for d, s in sets.items():
        for g in s:
            index.setdefault(g, []).append(d)
    shared = Counter()
    for ids in index.values():
        for i, a in enumerate(ids):
            for b in ids[i + 1:]:
                shared[a, b] += 1
    for (a, b), n in shared.items():
        if 100 * n >= percent * (len(sets[a]) + len(sets[b]) - n):
            x, y = sorted((find(a), find(b)))
            root[y] = x
    low = {}
    for d in sets:
        low[find(d)] = min(low.get(find(d), d), d)
    return {d: (len(s), low[find(d)]) for d, s in sets.items()}


def remove_repeats(docs, length):
    """doc_id -> (n_bytes, n_removed, n_spans, sha256 of the rest)."""
    data = {d: (t or "").encode() for d, t in docs}
    seen = Counter(b[i:i + length] for b in data.values() for i in range(len(b) - length + 1))
    out = {}
    for d, b in data.items():
        drop = bytearray(len(b))
        for i in range(len(b) - length + 1):
            if seen[b[i:i + length]] > 1:
                drop[i:i + length] = b"\1" * length
        rest = bytes(c for c, x in zip(b, drop) if not x)
        spans = sum(1 for i, x in enumerate(drop) if x and (i == 0 or not drop[i - 1]))
        out[d] = (len(b), sum(drop), spans, hashlib.sha256(rest).hexdigest())
    return out


def held_out(doc_id):
    return zlib.crc32(str(doc_id).encode()) % 5 == 0


def damaged(rows):
    """The contract's damage of (conv_id, turn, role, text) rows."""
    out = []
    for conv, turn, role, text in rows:
        role, text = (" " if x is None else x for x in (role, text))
        key = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        kind = zlib.crc32(key.encode()) % 20
        if kind == 0:
            continue
        if kind == 1:
            text = ""
        if kind == 2:
            text = re.sub(r"[.!?]", "", text)
        if kind == 4:
            role = "user"
        out += [(conv, turn, role, text)] * (2 if kind == 3 else 1)
    return out


def faults(rows):
    """blank, duplicate, truncated or none for each ordered (role, text)."""
    seen, out = set(), []
    for role, text in rows:
        last = re.findall(r"[^\x20\x09-\x0D]", text)
        out.append("blank" if not last else "duplicate" if (role, text) in seen else "truncated" if last[-1] not in ".!?" else None)
        seen.add((role, text))
    return out


def repaired(rows):
    """(cost, audit, lines) of the cheapest repair: every state of (s?(ua)+)? after every row, whole audits."""
    step = {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("u", "a"): "a", ("a", "u"): "u"}

    def better(best, state, way):
        if state not in best or way[:2] < best[state][:2]:
            best[state] = way
            return True
        return False

    def inserted(best):
        todo = list(best)
        while todo:
            state = todo.pop()
            cost, audit, lines = best[state]
            for x, role in (("u", "user:"), ("a", "assistant:")):
                if (state, x) in step and better(best, step[state, x], (cost + 3, audit + "I", (*lines, role))):
                    todo.append(step[state, x])
        return best

    level = {"": (0, "", ())}
    for (role, text), fault in zip(rows, faults(rows), strict=True):
        nxt = {}
        for state, (cost, audit, lines) in inserted(dict(level)).items():
            better(nxt, state, (cost + 4, audit + "D", lines))
            if fault in ("blank", "duplicate"):
                continue
            more = 3 if fault else 0
            for x, name, price, edit in ((role[:1], role, 0, "K"), ("u", "user", 3, "R"), ("a", "assistant", 3, "R")):
                if (state, x) in step:
                    better(nxt, step[state, x], (cost + price + more, audit + edit, (*lines, f"{name}:{text}")))
        level = nxt
    return min(v for k, v in inserted(level).items() if k in ("", "a"))


def repair_report(rows):
    """conv_id -> gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256."""
    out = {}
    for conv in {r[0] for r in rows}:
        mine = sorted((r[1:] for r in damaged(rows) if r[0] == conv), key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))
        turns = {t for t, _, _ in mine if t is not None}
        pairs = [(role, text) for _, role, text in mine]
        found = Counter(faults(pairs))
        illegal = sum(a[0][:1] + b[0][:1] not in ("su", "ua", "au") for a, b in zip(pairs, pairs[1:], strict=False))
        cost, audit, lines = repaired(pairs)
        gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
        out[conv] = (gaps, found["blank"], found["duplicate"], found["truncated"], illegal, cost, audit,
                     hashlib.sha256("\n".join(lines).encode()).hexdigest())
    return out


def winnowed(data, k, w):
    """[(hash, position)] of every window's least gram hash, rightmost of equal ones."""
    import xxhash

    if not data:
        return []
    bits = (1 << 33) - 1

    def signed(h):  # order of the 33 bits as the upper part of a signed number
        return h - (1 << 33) if h >> 32 else h

    grams = [xxhash.xxh64_intdigest(data[i:i + k], seed=42) & bits for i in range(max(1, len(data) - k + 1))]
    out = set()
    for i in range(max(1, len(grams) - w + 1)):
        out.add(min((signed(h), -(i + j)) for j, h in enumerate(grams[i:i + w])))
    return sorted(((h & bits, -p) for h, p in out), key=lambda x: x[1])


def edit_report(rows, k, w):
    """(doc_id, n_chars, sha, fingerprint, edited fingerprint, near_edited, near_next) of (doc_id, text), ids unique."""
    rows = sorted(((d, t or "") for d, t in rows), key=lambda r: (r[0] is not None, r[0] or 0))

    def near(a, b):
        a, b = {h for h, _ in a}, {h for h, _ in b}
        return len(a & b) / len(a | b) if a | b else 1.0

    def shown(grams):
        return " ".join(f"{h:x}:{p}" for h, p in grams)

    own = [winnowed(t.encode(), k, w) for _, t in rows]
    out = []
    for i, (d, t) in enumerate(rows):
        j, q = (i + 1) % len(rows), len(t) // 4
        edited = t[:len(t) - q] + rows[j][1][:q]
        e = winnowed(edited.encode(), k, w)
        out.append((d, len(t), hashlib.sha256(edited.encode()).hexdigest(), shown(own[i]), shown(e), near(own[i], e), near(own[i], own[j])))
    return out


def source_audit(rows, min_docs, top):
    """Sorted (lang, source, part, item, value, rank) of (lang, source, text) rows."""
    pattern = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
    count, docs, groups = {}, Counter(), set()
    for lang, source, text in rows:
        lang, source = lang or "", source or ""
        groups.add((lang, source))
        terms = pattern.findall(ascii_lower(text))
        count.setdefault((lang, source), Counter()).update(terms)
        docs.update((lang, t) for t in set(terms))
    out = []
    for lang in {g for g, _ in groups}:
        kept = [t for (g, t), n in docs.items() if g == lang and n >= min_docs]
        sources = sorted(s for g, s in groups if g == lang)

        def shares(c, kept=kept):
            n = sum(c[t] for t in kept)
            return {t: 1 + 10**9 * (c[t] + 5) // (n + 5 * len(kept)) for t in kept}

        p = {s: shares(count[lang, s]) for s in sources}
        usual = shares(sum((count[lang, s] for s in sources), Counter()))
        for s in sources:
            pair = [(sum(abs(p[s][t] - p[o][t]) for t in kept), o) for o in sources if o != s]
            term = [(p[s][t] - usual[t], t) for t in kept if count[lang, s][t] > 0 and p[s][t] > usual[t]]
            for part, items, most in (("pair", pair, None), ("term", term, top)):
                items.sort(key=lambda x: (-x[0], x[1].encode()))
                out += [(lang, s, part, o, v, i + 1) for i, (v, o) in enumerate(items[:most])]
    return sorted(out)
