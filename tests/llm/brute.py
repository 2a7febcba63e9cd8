"""Plain Python versions of the operators, for small inputs."""

import hashlib
import re

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def quality(text):
    text = text or ""
    w = WORD.findall(text)
    tri = [tuple(w[i : i + 3]) for i in range(len(w) - 2)]
    count = {}
    for t in tri:
        count[t] = count.get(t, 0) + 1
    covered = {i + j for i, t in enumerate(tri) if count[t] > 1 for j in range(3)}
    seen, dup = set(), 0
    for line in text.split("\n"):
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    return {
        "n_words": len(w),
        "word_chars": sum(map(len, w)),
        "n_symbols": sum(c in "#*$%&|<>" for c in text),
        "n_dup_lines": dup,
        "n_repeat_words": len(covered),
        "base_failed": len(w) < 50 or 100 * len(covered) > 50 * len(w),
    }


def luhn(d):
    total = 0
    for i, c in enumerate(reversed(d)):
        v = int(c) * (1 + i % 2)
        total += v - 9 if v > 9 else v
    return total % 10 == 0


PII = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def base_spans(text):
    out = []
    for order, (kind, pattern) in enumerate(PII.items()):
        for m in re.finditer(pattern, text or ""):
            v = m.group()
            d = re.sub("[^0-9]", "", v)
            if kind == "ip" and any(int(x) > 255 for x in v.split(".")):
                continue
            if kind == "card" and not (14 <= len(d) <= 19 and luhn(d)):
                continue
            if kind == "phone" and not 10 <= len(d) <= 15:
                continue
            out.append((m.start(), order, m.end(), kind))
    return [f"{k}:{a}:{b}" for a, _, b, k in sorted(out)]


def split_url(url):
    if not url or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    host = re.match(r"[^/?#]*", rest).group()
    path = re.match(r"[^?#]*", rest[len(host) :]).group()
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in host), path


def url_rule(host, path, rules):
    fit = [(len(h + p), v == "block", h + p, v) for h, p, v in rules if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return max(fit)[2:] if fit else (None, None)


def repeated_bytes(texts, k=400):
    """(n_bytes, n_removed, n_spans, sha256 of the rest) of each text."""
    data = [(t or "").encode() for t in texts]
    starts = {}
    for d in data:
        for i in range(len(d) - k + 1):
            starts[d[i : i + k]] = starts.get(d[i : i + k], 0) + 1
    out = []
    for d in data:
        gone = bytearray(len(d))
        for i in range(len(d) - k + 1):
            if starts[d[i : i + k]] > 1:
                gone[i : i + k] = b"\1" * k
        spans = sum(gone[i] and not (i and gone[i - 1]) for i in range(len(d)))
        out.append((len(d), sum(gone), spans, hashlib.sha256(bytes(c for c, g in zip(d, gone) if not g)).hexdigest()))
    return out


def repeated_words(rows, k=50):
    """rows: (doc_id, text); null ids are larger than all others."""
    big = 2**63 - 1
    first = {}
    words = [(big if i is None else i, WORD.findall(t or "")) for i, t in rows]
    for i, w in words:
        for a in range(len(w) - k + 1):
            key = tuple(w[a : a + k])
            first[key] = min(first.get(key, big), i)
    out = []
    for i, w in words:
        gone = [False] * len(w)
        for a in range(len(w) - k + 1):
            if first[tuple(w[a : a + k])] < i:
                gone[a : a + k] = [True] * k
        kept = " ".join(x for x, g in zip(w, gone) if not g)
        out.append((len(w), sum(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return out


def shingles(text, k=5):
    w = WORD.findall(text or "")
    if not w:
        return frozenset()
    return frozenset(tuple(w[i : i + k]) for i in range(max(1, len(w) - k + 1)))
