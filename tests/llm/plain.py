"""Plain, slow versions of the operators, for comparison."""

import re
from collections import Counter

import numpy as np
import xxhash
from tokenizers import Tokenizer

from vaultline.llm import quality
from vaultline.llm.tokens import vocabulary_path

WORD = re.compile(r"[^\x20\x09-\x0D]+")
BITS = 64


def lower(text):
    return re.sub("[A-Z]", lambda m: chr(ord(m[0]) + 32), text)


def tokenizer(special_as_text=False):
    t = Tokenizer.from_file(vocabulary_path())
    t.encode_special_tokens = special_as_text
    return t


def simhash(text):
    words = WORD.findall(lower(text or ""))
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), seed=42) for s in shingles]
    return sum(1 << b for b in range(BITS) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def groups(items, linked):
    """Index -> least index reachable."""
    parent = list(range(len(items)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in range(len(items)):
        for b in range(a):
            if linked(items[a], items[b]):
                x, y = find(a), find(b)
                parent[max(x, y)] = min(x, y)
    return [find(i) for i in range(len(items))]


def keys(text):
    return [lower(x.strip(" \t\n\x0b\x0c\r")) for x in (text or "").split("\n")]


def line_dedup(texts, threshold=10):
    times = Counter(k for t in texts for k in set(keys(t)) if k)
    out = []
    for t in texts:
        lines = (t or "").split("\n")
        stay = [x for x, k in zip(lines, keys(t)) if times[k] < threshold]
        out.append((len(lines), len(lines) - len(stay), "\n".join(stay)))
    return out


def measures(text):
    text = text or ""
    words = WORD.findall(text)
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    covered = {i + j for i, w in enumerate(windows) if windows.count(w) > 1 for j in range(3)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    return (
        len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)),
        sum(x in lines[:i] for i, x in enumerate(lines)), len(covered), len(lines), len(re.findall("[A-Z]", text)),
    )


def verdicts(rows, min_group=quality.MIN_GROUP):
    """kept for rows (text, lang, source), with the estimates in plain NumPy."""
    stats = [measures(r[0]) for r in rows]
    failed = [s[0] < 50 or 100 * s[4] > 50 * s[0] for s in stats]

    def vector(s):
        chars = max(s[1], 1)
        return [np.log(chars / max(s[0], 1)), np.sqrt(s[2] / chars), s[3] / max(s[5], 1), s[4] / max(s[0], 1), np.sqrt(s[6] / chars)]

    fine = {}
    for (text, lang, source), s, f in zip(rows, stats, failed):
        if not f:
            fine.setdefault((lang, source), {})[text] = vector(s)
    pool = Counter()
    for (lang, _), v in fine.items():
        if len(v) < min_group:
            pool[lang] += len(v)
    name = {g: g if len(v) >= min_group else (g[0],) if pool[g[0]] >= min_group else () for g, v in fine.items()}
    dealt = {}
    for g, v in fine.items():
        dealt.setdefault(name[g], []).extend(v.values())
    res = np.array(list(quality.RESOLUTION.values()))
    d = len(res)
    factor = quality.SHARE / quality.chi_squared(quality.chi_squared_quantile(quality.SHARE, d), d + 2)
    fits = {}
    for g, v in dealt.items():
        if len(v) < quality.FEWEST:
            continue
        x = np.array(v)
        q = np.quantile(x, [0.25, 0.5, 0.75], axis=0, method="inverted_cdf")
        center, whole = q[1], np.diag(((q[2] - q[0]) / 1.349) ** 2 + res**2)
        for _ in range(quality.STEPS):
            d2 = np.einsum("ij,jk,ik->i", x - center, np.linalg.inv(whole), x - center)
            y = x[d2 <= np.quantile(d2, quality.SHARE, method="inverted_cdf")]
            center = y.mean(axis=0)
            whole = factor * (y - center).T @ (y - center) / len(y) + np.diag(res**2)
        fits[g] = center, np.linalg.inv(whole)
    cut = quality.chi_squared_quantile(1 - quality.REJECT, d)
    out = []
    for (_, lang, source), s, f in zip(rows, stats, failed):
        fit = fits.get(name.get((lang, source)))
        off = None if fit is None else np.array(vector(s)) - fit[0]
        out.append(not f and (off is None or off @ fit[1] @ off <= cut))
    return stats, failed, out


EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        v = int(c) * (2 if i % 2 else 1)
        total += v - 9 if v > 9 else v
    return total % 10 == 0


def personal(text):
    digits = lambda m: re.sub("[^0-9]", "", m[0])
    rules = [
        ("email", EMAIL, lambda m: True),
        ("ip", IP, lambda m: all(int(x) <= 255 for x in m[0].split("."))),
        ("card", CARD, lambda m: 14 <= len(digits(m)) <= 19 and luhn(digits(m))),
        ("phone", PHONE, lambda m: 10 <= len(digits(m)) <= 15),
    ]
    found = [(m.start(), i, k, m.end()) for i, (k, p, ok) in enumerate(rules) for m in p.finditer(text or "") if ok(m)]
    return [(k, a, b) for a, _, k, b in sorted(found)]


def pieces(ids, capacity=1024):
    head = len(ids) % capacity if len(ids) > capacity else len(ids)
    cuts = ([0, head] if head else [0]) + list(range(head + capacity, len(ids) + 1, capacity))
    return [(a, b - a) for a, b in zip(cuts, cuts[1:])]


def check_packing(rows, capacity=1024):
    """rows of (sequence_id, offset, length): gapless within the capacity; the number of sequences."""
    by = {}
    for sequence, offset, length in rows:
        by.setdefault(sequence, []).append((offset, length))
    for found in by.values():
        at = 0
        for offset, length in sorted(found):
            assert offset == at and 0 < length <= capacity
            at += length
        assert at <= capacity
    return len(by)
