"""Plain single-process versions that the operators are compared with."""

import base64
import hashlib
import re
import struct

import public_tokenizers
import tiktoken
import xxhash


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower(text))


# --- decontamination
def contamination(docs, items, span=10):
    """{row number: (n_words, n_hit, sorted item ids)}"""
    windows = {}
    for item, text in items:
        w = words(text)
        k = min(span, len(w))
        for i in range(len(w) - k + 1 if k else 0):
            windows.setdefault((k, tuple(w[i : i + k])), set()).add(item)
    sizes = {k for k, _ in windows}
    out = []
    for text in docs:
        w = words(text)
        hit, found = set(), set()
        for k in sizes:
            for i in range(len(w) - k + 1):
                items_here = windows.get((k, tuple(w[i : i + k])))
                if items_here:
                    hit |= set(range(i, i + k))
                    found |= items_here
        out.append((len(w), len(hit), sorted(str(x) for x in found if x is not None)))
    return out


# --- simhash
def simhash(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", lower(text))
    if not w:
        return 0
    shingles = [" ".join(w[i : i + 3]) for i in range(max(1, len(w) - 2))]
    ones = [0] * 64
    for s in shingles:
        h = xxhash.xxh64_intdigest(s.encode(), 42)
        for b in range(64):
            ones[b] += h >> b & 1
    return sum(1 << b for b in range(64) if ones[b] * 2 > len(shingles))


def components(values, bits=3):
    """Root of each distinct value under links of at most ``bits`` differing bits."""
    values = sorted(set(values))
    root = {v: v for v in values}

    def find(v):
        while root[v] != v:
            v = root[v]
        return v

    for i, a in enumerate(values):
        for b in values[i + 1 :]:
            if (a ^ b).bit_count() <= bits:
                root[find(b)] = find(a)
    return {v: find(v) for v in values}


# --- personal data
BASE = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def valid(kind, match):
    digits = re.sub("[^0-9]", "", match)
    if kind == "ip":
        return all(int(x) <= 255 for x in match.split("."))
    if kind == "card":
        return 13 <= len(digits) <= 19 and luhn(digits)
    return kind == "email" or 9 <= len(digits) <= 15


def base_spans(text):
    return [(k, m.start(), m.end()) for k, p in BASE.items() for m in re.finditer(p, text or "") if valid(k, m.group())]


# --- byte-level BPE
def encoding():
    with open(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


# --- winnowed fingerprints
def entries(text, gram=4, window=8):
    """[(hash, position)] of 4-grams of words, built by pairs of pairs."""
    w = [x for x in re.split(r"[ \t-\r]+", text.lower()) if x]
    if not w:
        return []
    hashes = [xxhash.xxh64_intdigest(x.encode(), 42) for x in w]
    pair = lambda a, b: xxhash.xxh64_intdigest(struct.pack("<Q", b), xxhash.xxh64_intdigest(struct.pack("<Q", a), 42))
    if len(w) < gram:
        seed = 42
        for x in w:
            seed = xxhash.xxh64_intdigest(x.encode(), seed)
        grams = [seed]
    else:
        twos = [pair(a, b) for a, b in zip(hashes, hashes[1:], strict=False)]
        grams = [pair(a, b) for a, b in zip(twos, twos[2:], strict=False)]
    out = []
    for i in range(max(1, len(grams) - window + 1)):
        h, at = min((g >> 31, -(i + j)) for j, g in enumerate(grams[i : i + window]))
        if not out or out[-1] != (h, -at):
            out.append((h, -at))
    return out


def digest(found):
    return hashlib.sha256(",".join("%X" % ((h << 30) | ((1 << 30) - 1 - at)) for h, at in found).encode()).hexdigest()


def jaccard(a, b):
    a, b = {h for h, _ in a}, {h for h, _ in b}
    return 1.0 if not a and not b else len(a & b) / len(a | b)
