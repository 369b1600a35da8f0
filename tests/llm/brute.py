"""Plain versions of the operators, for small inputs."""

from __future__ import annotations

import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import xxhash
import zstandard


def words(text: str | None) -> list[str]:
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def lowered(text: str | None) -> str:
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def fingerprint(text: str | None) -> int:
    found = words(lowered(text))
    shingles = [" ".join(found[i : i + 4]) for i in range(max(1, len(found) - 3))] if found else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def components(fingerprints: list[int], most: int = 4) -> list[int]:
    root = list(range(len(fingerprints)))

    def find(x: int) -> int:
        while root[x] != x:
            x = root[x]
        return x

    for i, a in enumerate(fingerprints):
        for j in range(i):
            if (a ^ fingerprints[j]).bit_count() <= most:
                x, y = find(i), find(j)
                root[max(x, y)] = min(x, y)
    return [find(i) for i in range(len(fingerprints))]


def removals(rows: list[tuple[int | None, str | None]], length: int = 100) -> list[tuple]:
    """``doc_id, n_bytes, n_removed, n_spans, kept_sha256`` of rows whose ids differ."""
    seen: set[bytes] = set()
    out = []
    for doc, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0)):
        raw = (text or "").encode()
        mark = bytearray(len(raw))
        for at in range(len(raw) - length + 1):
            string = raw[at : at + length]
            if string in seen:
                mark[at : at + length] = b"\1" * length
            seen.add(string)
        rest = bytes(b for b, m in zip(raw, mark) if not m)
        spans = sum(1 for i, m in enumerate(mark) if m and (i == 0 or not mark[i - 1]))
        out.append((doc, len(raw), len(raw) - len(rest), spans, hashlib.sha256(rest).hexdigest()))
    return out


def mixture(rows: list[tuple[int | None, str | None, str | None]]) -> list[tuple]:
    """``doc_id, size, source_size, target, taken`` by filling targets step by step and sorting hashes."""
    sizes = [len(words(text)) for _, _, text in rows]
    total: dict[str | None, int] = defaultdict(int)
    for (_, source, _), size in zip(rows, sizes):
        total[source] += size
    order = sorted(total, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
    target: dict[str | None, float] = {}
    free, left = list(order), float(sum(sizes))
    while free:
        share = left / sum(weight[s] for s in free)
        over = [s for s in free if weight[s] * share > 3 * total[s]]
        if not over:
            target |= {s: weight[s] * share for s in free}
            break
        for s in over:
            target[s] = 3.0 * total[s]
            left -= target[s]
            free.remove(s)
    md5 = lambda t: hashlib.md5(t.encode()).hexdigest()
    seen: Counter = Counter()
    place = []
    for d, source, text in rows:
        key = md5(f"{'' if d is None else d}|{'n' if source is None else 's' + source}|{md5(text or '')}")
        place.append(int(md5(f"{key}:{seen[key]}")[:9], 16))
        seen[key] += 1
    limit: dict[str | None, tuple[int, int]] = {}
    for s in order:
        copies = math.floor(target[s] / total[s]) if total[s] else 0
        budget, below, edge = target[s] - copies * total[s], 0, 0
        by: dict[int, int] = defaultdict(int)
        for (_, source, _), size, h in zip(rows, sizes, place):
            if source == s:
                by[h] += size
        for h in sorted(by):
            if below <= budget < below + by[h]:
                edge = h + (2 * (budget - below) >= by[h])
                break
            below += by[h]
        limit[s] = copies, edge
    return [
        (d, size, total[s], target[s], size * (limit[s][0] + (h < limit[s][1])))
        for (d, s, _), size, h in zip(rows, sizes, place)
    ]


def kneser_ney(rows: list[tuple[int | None, str | None]], order: int) -> list[tuple]:
    """``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score``."""
    def remainder(doc: int | None) -> int:
        return zlib.crc32(("" if doc is None else str(doc)).encode()) % 5

    def discounts(of: Counter) -> list[float]:
        n = [sum(1 for v in of.values() if v == k) for k in (1, 2, 3, 4)]
        if not all(n):
            return [0, 0.5, 1.0, 1.5]
        y = n[0] / (n[0] + 2 * n[1])
        return [0] + [min(max(k - (k + 1) * y * n[k] / n[k - 1], 0.05), k - 0.05) for k in (1, 2, 3)]

    begin = ["\n"] * (order - 1)
    tokens = [[*words(lowered(text)), None] for _, text in rows]
    learnt = [t for (doc, _), t in zip(rows, tokens) if remainder(doc) != 1]
    counts = Counter(w for t in learnt for w in t)
    total, distinct = sum(counts.values()), len(counts)
    grams = {order: Counter(tuple((begin + t)[i : i + order]) for t in learnt for i in range(len(t)))}
    for k in range(order - 1, 0, -1):
        grams[k] = Counter(g[1:] for g in grams[k + 1])
    taken = {k: discounts(grams[k]) for k in grams}
    sums, kinds = defaultdict(int), defaultdict(lambda: [0, 0, 0])
    for k in grams:
        for g, n in grams[k].items():
            sums[g[:-1]] += n
            kinds[g[:-1]][min(n, 3) - 1] += 1

    def likely(gram: tuple) -> float:
        k, context = len(gram), gram[:-1]
        lower = likely(gram[1:]) if k > 1 else 1 / (distinct + 1)
        if not sums[context]:
            return lower
        n = grams[k][gram]
        free = sum(a * b for a, b in zip(kinds[context], taken[k][1:])) / sums[context]
        return (n - taken[k][min(n, 3)]) / sums[context] + free * lower

    out = []
    for (doc, _), text in zip(rows, tokens):
        score = sum(math.log10(likely(tuple((begin + text)[i : i + order]))) for i in range(len(text)))
        base = sum(math.log10((counts[w] + 0.5) / (total + 0.5 * (distinct + 1))) for w in text)
        out.append((doc, remainder(doc) == 1, len(text), sum(w in counts for w in text), total, base, score))
    return out


def quality_score(model, text: str | None) -> float:
    """The forward pass of a quality model: numbers of all words and n-grams averaged, then softmax of two."""
    base, down, found, before = 0x9E3779B97F4A7C15, 32 - model.bits, [], None
    for match in re.finditer(rb"[^\x20\x09-\x0D]+", (text or "").encode()):
        word = match[0]
        h = sum(b * pow(base, n, 1 << 64) for n, b in enumerate(word, 1)) % (1 << 64)
        found.append(0 if (word, match.start() - 1) == before else (h ^ h >> 29) * base % (1 << 64) >> (64 - model.bits))
        before, spaced = (word, match.end()), b" " + word + b" "
        for n, seed, factor in ((3, 0, 2654435761), (4, 0x5BD1E995, 2246822519)):
            for at in range(len(spaced) - n + 1):
                gram = spaced[at : at + n]
                if gram.strip(b" ") and len(gram.strip(b" ")) >= 2:
                    hashed = (int.from_bytes(gram, "little") ^ seed) * factor % (1 << 32) >> down
                    found.append(hashed + (1 << model.bits))
    if not found:
        return model.empty
    return 1 / (1 + math.exp(-(sum(float(model.numbers[f]) for f in found) / len(found) + model.bias)))


def toxicity_score(model, text: str | None, window: int = 48, stride: int = 24, level: int = 6) -> float:
    """The score of a toxicity model, one window compressed at a time."""
    settings = zstandard.ZstdCompressionParameters.from_level(level, write_content_size=0, write_checksum=0, write_dict_id=0)

    def compressor(raw: bytes):
        content = zstandard.ZstdCompressionDict(raw, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        return zstandard.ZstdCompressor(dict_data=content, compression_params=settings)

    raw = b" " + re.sub(rb"[\t-\r]", b" ", lowered(text).encode()) + b" "
    cut = [raw[a : a + window] for a in range(0, max(1, len(raw) - window + stride), stride)]
    numbers = []
    for pair in model.pairs:
        ordinary, toxic = map(compressor, pair)
        gains = [len(ordinary.compress(w)) - len(toxic.compress(w)) for w in cut]
        numbers += [sum(max(g - least, 0) for g in gains) / math.sqrt(len(cut)) for least in (1, 2, 3, 5)]
        numbers.append(max(-1, *gains) if len(gains) > 1 else max(-1, gains[0]))
    numbers += [math.log1p(len(cut)), 1.0]
    return 1 / (1 + math.exp(-sum(a * b for a, b in zip(numbers, model.curve.tolist()))))


def nearest(rows: list[tuple[int, list[float]]], queries: set[int], k: int, scale: float | None = None) -> dict:
    """Query id to ``(id, score)`` lists, by inner product of (scaled and floored) vectors."""
    value = {i: np.floor(scale * np.array(v)) if scale else np.array(v, dtype=float) for i, v in rows}
    out = {}
    for q in queries:
        scored = [(i, float((value[q] * v).sum())) for i, v in value.items() if i != q]
        out[q] = sorted(scored, key=lambda s: (-s[1], s[0]))[:k]
    return out


def planted(doc: int | None, found: list[str]) -> list[str]:
    h = zlib.crc32(("" if doc is None else str(doc)).encode())
    g, n = h // 10, len(found)
    if h % 10 or not n:
        return found
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [found[i] if i < a else found[a + (i - a) % p] for i in range(n)]


def periodic(found: list) -> list[tuple[int, int, int]]:
    """``start, length, period`` of all runs, lag by lag."""
    out, seen = [], set()
    for q in range(1, len(found) // 4 + 1):
        i = 0
        while i + q < len(found):
            j = i
            while j + q < len(found) and found[j] == found[j + q]:
                j += 1
            run = i, j - i + q
            if j > i and run[1] >= max(6, 4 * q) and run not in seen:
                seen.add(run)
                out.append((*run, q))
            i = max(j, i + 1)
    return sorted(out, key=lambda r: (r[0], r[2]))


def run_digests(doc: int | None, text: str | None) -> tuple:
    """The row of the periodic run query for a document."""
    found = planted(doc, words(text))
    runs = periodic(found)
    kept = [w for i, w in enumerate(found) if not any(s + q <= i < s + m for s, m, q in runs)]
    best = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=(None, None, None))
    lines = "".join(f"{s},{m},{q}\n" for s, m, q in runs)
    digest = lambda t: hashlib.sha256(t.encode()).hexdigest()
    milli = 1000 * best[1] // best[2] if runs else None
    return doc, len(runs), *best, milli, digest(lines), digest(" ".join(kept))
