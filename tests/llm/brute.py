"""Plain results to hold the corpus operators against, text by text or pair by pair."""

import hashlib
import re
import zlib
from collections import Counter, defaultdict

import xxhash

SPACE = " \t\n\v\f\r"


def words(text):
    return [w for w in re.split("[\x20\x09-\x0d]+", text or "") if w]


def listed(spans, order):
    ranked = sorted(spans, key=lambda s: (s[1], order.index(s[0]), s[2]))
    return ",".join(f"{k}:{a}:{b}" for k, a, b in ranked)


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def matches(kind, pattern, text, good=lambda m: True):
    return [(kind, m.start(), m.end()) for m in re.finditer(pattern, text or "") if good(m)]


# --- secrets ---------------------------------------------------------------------------------------

_KEYS = r"(?ai:password|passwd|secret|token|api_?key)"
_SET = r"""["']?\x20*[:=]\x20*["']?"""


def secrets(text, reach, weak_reach):
    base = (
        matches(
            "assign", f"({_KEYS}){_SET}([A-Za-z0-9+/_.=-]+)", text, lambda m: len(m[2]) >= 8
        )
        + matches("access", "AKIA[A-Z0-9]+", text, lambda m: len(m[0]) >= 16)
        + matches("hex", "[0-9a-f]+", text, lambda m: len(m[0]) >= 32)
    )

    def material(m):
        s = m[0]
        return all(re.search(c, s) for c in ("[a-z]", "[A-Z]", "[0-9]")) and len(set(s)) >= 14

    weak = (
        matches(
            "key_material",
            "(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_-]{24,}+={0,2}+(?![A-Za-z0-9+/_=-])",
            text,
            material,
        )
        + matches(
            "account",
            rf"(?<![A-Za-z0-9_])(?ai:user(?:_?name)?|login|account|client_?id|access_?key_?id){_SET}"
            "[A-Za-z0-9@._-]{3,}",
            text,
        )
        + matches(
            "endpoint", r"""(?<![A-Za-z0-9+.-])[A-Za-z][A-Za-z0-9+.-]*+://[^\s"'<>]+""", text
        )
    )
    role = {"assign": "s", "hex": "s", "key_material": "s", "access": "i", "account": "i", "endpoint": "e"}
    need = {"key_material": "ie", "account": "s", "endpoint": "s"}
    everything = base + weak
    lines, at, breaks = (text or "").split("\n"), 0, []
    for i, line in enumerate(lines):
        bare = line.strip(" \t\r")
        closes = bare[:1] in ("}", "]", ")") if bare else i < len(lines) - 1
        if i and (closes or re.fullmatch(r"\[[^\]\n]+\]", bare)):
            breaks.append(at - 1)
        at += len(line) + 1

    def confirms(w, o):
        (k, a, b), (other, c, d) = w, o
        if role[other] not in need[k] or not (d <= a or b <= c):
            return False
        if sum(x <= a for x in breaks) != sum(x <= c for x in breaks):
            return False
        return max(c - b, a - d) <= (reach if o in base else weak_reach)

    linked = [w for w in weak if any(confirms(w, o) for o in everything)]
    order = ["assign", "access", "hex", "key_material", "account", "endpoint"]
    count = Counter(k for k, _, _ in base)
    return (
        *[count[k] for k in order[:3]],
        sha(listed(base, order)),
        listed(base + linked, order),
    )


# --- personal data ---------------------------------------------------------------------------------


def luhn(match):
    d = [int(c) for c in re.sub("[^0-9]", "", match)][::-1]
    if not 12 <= len(d) <= 19:
        return False
    return sum(x if i % 2 == 0 else sum(divmod(2 * x, 10)) for i, x in enumerate(d)) % 10 == 0


def personal(text):
    return (
        matches("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)
        + matches(
            "ip",
            r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
            text,
            lambda m: all(int(p) <= 255 for p in m[0].split(".")),
        )
        + matches("card", r"[0-9]([\x20-]?[0-9])+", text, lambda m: luhn(m[0]))
        + matches(
            "phone",
            r"\+[0-9][\x20().0-9-]+[0-9]",
            text,
            lambda m: 9 <= sum(c.isdigit() for c in m[0]) <= 15,
        )
    )


def iban(number):
    n = number.replace(" ", "")
    turned = n[4:] + n[:4]
    return int("".join(str(int(c, 36)) for c in turned)) % 97 == 1


# --- packing ---------------------------------------------------------------------------------------


def pieces_are_whole(rows, ids_of, limit=2048):
    """Every id in one piece, places gapless, nothing above the limit."""
    by_doc, by_seq = defaultdict(list), defaultdict(list)
    for r in rows:
        by_doc[r["doc_id"]].append(r)
        by_seq[r["sequence_id"]].append((r["offset"], r["length"]))
    assert set(by_doc) == set(ids_of)
    for doc, ids in ids_of.items():
        at = 0
        for r in sorted(by_doc[doc], key=lambda r: r["start"]):
            assert r["start"] == at and r["length"] > 0 and r["doc_tokens"] == len(ids)
            data = b"".join(i.to_bytes(4, "little") for i in ids[at : at + r["length"]])
            assert r["ids_crc32"] == zlib.crc32(data)
            at += r["length"]
        assert at == len(ids)
    for places in by_seq.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= limit
    return len(by_seq)


# --- quality ---------------------------------------------------------------------------------------


def quality(text):
    text = text or ""
    ws = words(text)
    lines = [x for x in text.split("\n") if words(x)]
    windows = Counter(tuple(ws[i : i + 3]) for i in range(len(ws) - 2))
    hit = {
        j for i in range(len(ws) - 2) if windows[tuple(ws[i : i + 3])] > 1 for j in range(i, i + 3)
    }
    return {
        "n_words": len(ws),
        "word_chars": sum(map(len, ws)),
        "n_symbols": sum(c in "#*$%&|<>" for c in text),
        "n_dup_lines": len(lines) - len(set(lines)),
        "n_repeat_words": len(hit),
        "base_failed": len(ws) < 50 or 100 * len(hit) > 50 * len(ws),
    }


def boilerplate(docs, most):
    """{row: words on boilerplate lines}; docs: (row, host, text)."""
    def norm(line):
        low = "".join(c.lower() if c.isascii() else c for c in line)
        return re.sub("[0-9]+", "0", " ".join(words(low)))

    hashed = lambda x: hashlib.md5(x.encode()).hexdigest()[:16]
    families, held = defaultdict(set), {}
    for row, host, text in docs:
        lines = [norm(x) for x in (text or "").split("\n") if words(x)]
        count = Counter()
        for x in lines:
            count[x] += len(words(x))
        names = {hashed(x): x for x in count}
        held[row] = (host, count)
        for h in names:
            families[host, h].add(min((o for o in names if o != h), default=""))
    return {
        row: sum(n for x, n in count.items() if len(families[host, hashed(x)]) > most)
        for row, (host, count) in held.items()
    }


# --- fingerprints ----------------------------------------------------------------------------------


def fingerprint(text, size=3):
    low = "".join(c.lower() if c.isascii() else c for c in text or "")
    ws = words(low)
    if not ws:
        return 0
    shingles = [" ".join(ws[i : i + size]) for i in range(len(ws) - size + 1)] or [" ".join(ws)]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(
        1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes)
    )


def components(nodes, linked):
    """{node: least node reachable} by comparing all pairs."""
    nodes = list(nodes)
    root = {n: n for n in nodes}

    def find(n):
        while root[n] != n:
            n = root[n]
        return n

    for i, a in enumerate(nodes):
        for b in nodes[:i]:
            if linked(a, b):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {n: find(n) for n in nodes}


# --- edit distance ---------------------------------------------------------------------------------


def edits(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


# --- repeated byte strings -------------------------------------------------------------------------


def repeats(docs, length=100):
    """{doc: (bytes, removed, spans, sha256 of the rest)}; docs: (doc_id, text) in order of id."""
    seen, out = set(), {}
    for doc, text in docs:
        data = (text or "").encode()
        gone = bytearray(len(data))
        for s in range(len(data) - length + 1):
            window = data[s : s + length]
            if window in seen:
                gone[s : s + length] = b"\1" * length
            seen.add(window)
        kept = bytes(c for c, g in zip(data, gone) if not g)
        out[doc] = (
            len(data),
            sum(gone),
            len(re.findall(b"\1+", bytes(gone))),
            hashlib.sha256(kept).hexdigest(),
        )
    return out


# --- contained items -------------------------------------------------------------------------------


def tokens(text):
    import regex

    return regex.findall(r"[\p{L}\p{M}\p{N}]+", (text or "").lower())


def shingles(text, size=5):
    ws = tokens(text)
    return {tuple(ws[i : i + size]) for i in range(len(ws) - size + 1)}


def contained(docs, items, least=0.8):
    sets = [(i, k, shingles(t, k)) for i, t in items for k in [min(5, len(tokens(t)))] if k]
    out = []
    for d, t in docs:
        own = {k: shingles(t, k) for k in range(1, 6)}
        for i, k, s in sets:
            if len(s & own[k]) >= least * len(s) - 1e-9:
                out.append((d, i, len(s), len(s & own[k])))
    return out


# --- urls ------------------------------------------------------------------------------------------


def url(u, rules):
    if u is None or "://" not in u:
        return "", "", None
    rest = u.split("://", 1)[1]
    host = re.match("[^/?#]*", rest)[0]
    path = re.match("[^?#]*", rest[len(host) :])[0]
    host = "".join(c.lower() if c.isascii() else c for c in host)
    fit = [
        (len(h) + len(p), h + p, v)
        for h, p, v in rules
        if (host == h or host.endswith("." + h)) and path.startswith(p)
    ]
    return host, path, max(fit)[1:] if fit else None
