"""The operators' results by plain loops over Python lists."""

from __future__ import annotations

import hashlib
from collections import defaultdict

import regex
import xxhash

from brackish.llm.decontam import LEAST_WINDOWS, LITERALS, UNITS, WINDOW

ASCII = b" \t\n\x0b\x0c\r"


def sha(data: bytes) -> str:
    return hashlib.sha256(data).hexdigest()


def dedupe_lines(docs, least_chars=20, least_docs=3):
    """{row: (text, lines, dropped)} of (doc_id, text) rows."""
    key = lambda line: line.strip(ASCII).lower()
    held = defaultdict(set)
    for doc, text in docs:
        if doc is not None:
            for line in (text or "").encode().split(b"\n"):
                if len(key(line).decode()) >= least_chars:
                    held[key(line)].add(doc)
    out = []
    for doc, text in docs:
        lines = (text or "").encode().split(b"\n")
        kept = [x for x in lines if doc is None or len(held.get(key(x), ())) < least_docs or max(held[key(x)]) == doc]
        out.append((doc, b"\n".join(kept).decode(), len(lines), len(lines) - len(kept)))
    return out


def fingerprint(text, words=3):
    have = (text or "").encode().lower().split()
    shingles = [b" ".join(have[i : i + words]) for i in range(max(1, len(have) - words + 1))] if have else []
    hashes = [xxhash.xxh64_intdigest(s, seed=42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def components(fingerprints, bits=3):
    """{doc: smallest doc reachable} of {doc: fingerprint}."""
    root = {d: d for d in fingerprints}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    docs = sorted(fingerprints)
    for i, a in enumerate(docs):
        for b in docs[i + 1 :]:
            if (fingerprints[a] ^ fingerprints[b]).bit_count() <= bits and find(a) != find(b):
                root[max(find(a), find(b))] = min(find(a), find(b))
    return {d: find(d) for d in docs}


def template(text):
    """[(token, value)] with typed placeholders."""
    text = text or ""
    for _ in range(2):
        text = regex.sub(r"(?<=[\p{Ll}\p{N},;\x01] )\p{Lu}\p{Ll}+", lambda m: "\x01" + m[0], text) if "\x01" not in text else text
    text = regex.sub(r"\p{N}+(?:[.,]\p{N}+)*", lambda m: f" \x02{m[0].replace('.', '·').replace(',', '‚')} ", text)
    text = regex.sub(r"(\x02[\p{N}·‚]*) +(%|(?:" + "|".join(UNITS) + r")\b)", lambda m: f"{m[1]} \x03{m[2]}", text)
    found = []
    for token in regex.findall(r"[\p{L}\p{M}\p{N}\x01\x02\x03·‚]+", text):
        found.append((token[0], token[1:]) if token[0] in "\x01\x02\x03" else (token.lower(), None))
    return found


def contaminated(docs, items):
    """{(doc, item)} by comparing every window of every document with every window of every item."""
    spots = defaultdict(list)
    counts = defaultdict(int)
    for item, text in items:
        tokens = template(text)
        n = min(WINDOW, len(tokens))
        for i in range(len(tokens) - n + 1 if n else 0):
            window = tokens[i : i + n]
            if sum(v is None for _, v in window) >= LITERALS:
                spots[tuple(t for t, _ in window)].append((item, i, [v for _, v in window if v is not None]))
                counts[item] += 1
    lengths = {len(k) for k in spots}
    pairs = set()
    for doc, text in docs:
        tokens = template(text)
        lines = defaultdict(list)
        for n in lengths:
            for i in range(len(tokens) - n + 1):
                window = tokens[i : i + n]
                for item, at, slots in spots.get(tuple(t for t, _ in window), ()):
                    lines[item, i - at].append((at, list(zip(slots, [v for _, v in window if v is not None], strict=True))))
        found = defaultdict(set)
        for (item, _), hits in lines.items():
            mapping = {p for _, slots in hits for p in slots}
            if len(mapping) == len({a for a, _ in mapping}):
                found[item] |= {at for at, _ in hits}
        pairs |= {(doc, item) for item, at in found.items() if len(at) >= min(LEAST_WINDOWS, counts[item])}
    return pairs


def repeats(docs, window):
    """[(doc, words, removed, kept)]"""
    first = {}
    for doc, text in docs:
        words = (text or "").encode().split()
        for i in range(len(words) - window + 1):
            key = tuple(words[i : i + window])
            first[key] = min(first.get(key, doc), doc)
    out = []
    for doc, text in docs:
        words = (text or "").encode().split()
        gone = set()
        for i in range(len(words) - window + 1):
            if first[tuple(words[i : i + window])] < doc:
                gone |= set(range(i, i + window))
        out.append((doc, len(words), len(gone), b" ".join(w for i, w in enumerate(words) if i not in gone).decode()))
    return out
