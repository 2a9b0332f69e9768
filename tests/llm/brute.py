"""Plain versions of the operators over lists of (doc_id, text), and small tables to try them on."""

from __future__ import annotations

import hashlib
import random
import re
from collections import Counter
from fractions import Fraction

import xxhash

SPACED = re.compile(r"[^\x20\x09-\x0D]+")
PLAIN = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LAST = float("inf")


def lower(text: str) -> str:
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def sha(text: str | bytes) -> str:
    return hashlib.sha256(text.encode() if isinstance(text, str) else text).hexdigest()


def order_key(doc_id: int | None) -> float:
    return LAST if doc_id is None else doc_id


def leaks(docs, items, window=10):
    windows: dict[tuple, set] = {}
    for item, text in items:
        words = PLAIN.findall(lower(text or ""))
        size = min(window, len(words))
        for i in range(len(words) - size + 1 if size else 0):
            windows.setdefault(tuple(words[i : i + size]), set()).add(item)
    out = []
    for doc, text in docs:
        words = PLAIN.findall(lower(text or ""))
        hit, found = set(), set()
        for size in {len(w) for w in windows}:
            for i in range(len(words) - size + 1):
                if tuple(words[i : i + size]) in windows:
                    hit |= set(range(i, i + size))
                    found |= windows[tuple(words[i : i + size])]
        names = sorted(str(item) for item in found if item is not None)
        out.append((doc, len(words), len(hit), len(names), sha(",".join(names)), bool(hit)))
    return out


def simhash(text: str | None, shingle=3) -> int:
    words = SPACED.findall(lower(text or ""))
    if not words:
        return 0
    size = min(shingle, len(words))
    grams = [" ".join(words[i : i + size]) for i in range(len(words) - size + 1)]
    hashes = [xxhash.xxh64_intdigest(gram.encode(), 42) for gram in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def near_components(docs, shingle=3, radius=3):
    prints = [simhash(text, shingle) for _, text in docs]
    group = list(range(len(docs)))
    for i in range(len(docs)):
        for j in range(i):
            near = (prints[i] ^ prints[j]).bit_count() <= radius
            if near and group[i] != group[j]:
                old, new = group[i], group[j]
                group = [new if g == old else g for g in group]
    out = []
    for (doc, _), value, own in zip(docs, prints, group, strict=True):
        ids = [d for (d, _), g in zip(docs, group, strict=True) if g == own and d is not None]
        out.append((doc, f"{value:016x}", min(ids, default=None)))
    return out


def shingles(text, size=5):
    words = SPACED.findall(lower(text or ""))
    size = min(size, len(words))
    return frozenset(tuple(words[i : i + size]) for i in range(len(words) - size + 1)) if words else frozenset()


def kept_of_similar(docs, least=Fraction(4, 5)):
    """The smallest id of each component of documents with similar shingle sets."""
    sets = [shingles(text) for _, text in docs]
    group = list(range(len(docs)))
    for i, one in enumerate(sets):
        for j, two in enumerate(sets[:i]):
            if group[i] != group[j] and (one == two or len(one & two) >= least * len(one | two)):
                group = [group[j] if g == group[i] else g for g in group]
    return sorted(
        (min((d for (d, _), g in zip(docs, group, strict=True) if g == own), key=order_key) for own in set(group)),
        key=repr,
    )


def quality(text: str | None):
    text = text or ""
    words = SPACED.findall(text)
    seen, repeated = set(), 0
    for line in text.split("\n"):
        if SPACED.search(line):
            repeated += line in seen
            seen.add(line)
    counts = Counter(zip(words, words[1:], words[2:]))
    covered = {i + k for i in range(len(words) - 2) if counts[tuple(words[i : i + 3])] > 1 for k in range(3)}
    symbols = sum(c in "#*$%&|<>" for c in text)
    failed = len(words) < 50 or 100 * len(covered) > 50 * len(words)
    return len(words), sum(map(len, words)), symbols, repeated, len(covered), failed


def byte_dedup(docs, length=100):
    """Flags of removed bytes per row, by the text of every string's starts."""
    texts = [(text or "").encode() for _, text in docs]
    least: dict[bytes, float] = {}
    for (doc, _), data in zip(docs, texts, strict=True):
        for i in range(len(data) - length + 1):
            key = data[i : i + length]
            least[key] = min(least.get(key, LAST), order_key(doc))
    out = []
    for (doc, _), data in zip(docs, texts, strict=True):
        gone, own = [False] * len(data), set()
        for i in range(len(data) - length + 1):
            key = data[i : i + length]
            if least[key] < order_key(doc) or key in own:
                gone[i : i + length] = [True] * length
            own.add(key)
        out.append(gone)
    return out


def byte_report(docs):
    out = []
    for (doc, text), gone in zip(docs, byte_dedup(docs), strict=True):
        data = (text or "").encode()
        spans = sum(g and not (i and gone[i - 1]) for i, g in enumerate(gone))
        kept = bytes(b for b, g in zip(data, gone, strict=True) if not g)
        out.append((doc, len(data), sum(gone), spans, sha(kept)))
    return out


def without_repeats(docs):
    out = []
    for (doc, text), gone in zip(docs, byte_dedup(docs), strict=True):
        at, kept = 0, []
        for letter in text or "":
            size = len(letter.encode())
            if not any(gone[at : at + size]):
                kept.append(letter)
            at += size
        out.append((doc, "".join(kept)))
    return out


def word_dedup(docs, window=13):
    least: dict[tuple, float] = {}
    split = [SPACED.findall(text or "") for _, text in docs]
    for (doc, _), words in zip(docs, split, strict=True):
        for i in range(len(words) - window + 1):
            key = tuple(words[i : i + window])
            least[key] = min(least.get(key, LAST), order_key(doc))
    out = []
    for (doc, _), words in zip(docs, split, strict=True):
        gone = set()
        for i in range(len(words) - window + 1):
            if least[tuple(words[i : i + window])] < order_key(doc):
                gone |= set(range(i, i + window))
        kept = " ".join(w for i, w in enumerate(words) if i not in gone)
        out.append((doc, len(words), len(gone), sha(kept)))
    return out


def passages(seed: int, count: int, letters: str = "ab é", words: int = 200) -> list[str]:
    rng = random.Random(seed)
    vocabulary = ["".join(rng.choice(letters.replace(" ", "")) for _ in range(rng.randint(1, 9))) for _ in range(words)]
    return [
        rng.choice([" ", " ", "\n"]).join(rng.choices(vocabulary, k=rng.randint(5, 120))) for _ in range(count)
    ]


def odd_documents(seed: int = 1) -> list[tuple[int | None, str | None]]:
    """NULLs, empty and long texts, repeated rows and ids, ties, shared and repeated passages."""
    rng = random.Random(seed)
    parts = passages(seed, 12)
    docs: list[tuple[int | None, str | None]] = [
        (n, " ".join(rng.choices(parts, k=rng.randint(1, 4)))) for n in range(5, 45)
    ]
    cut = parts[0]
    docs += [
        (1, None), (2, ""), (3, " \n\t "), (None, None), (None, parts[1] + " " + parts[2]),
        (None, parts[1] + " " + parts[2]), (60, parts[3]), (60, parts[3]), (60, parts[4]),
        (61, "a" * 5000), (62, "a" * 300 + "b" + "a" * 300), (63, "Only. Three Words"),
        (64, parts[5] * 60), (-4, cut[len(cut) // 3 :] + " tail é"), (65, "x" + cut + "y"),
        (66, "é" * 170), (67, "x" + "é" * 120),
    ]
    rng.shuffle(docs)
    return docs


CLASHING = ("block", "fp", "row", "doc", "rest", "failed", "n_words", "bucket", "label", "id", "_hits", "hit_words")


def as_table(spark, docs, clashing: bool = True):
    """The documents with columns named like those the operators use inside."""
    from pyspark.sql import functions as F

    df = spark.createDataFrame(docs, "doc_id bigint, text string").repartition(3)
    df = df.withColumn("lang", F.lit("en")).withColumn("n_chars", F.length("text").cast("bigint"))
    return df.withColumns({name: F.lit(name) for name in CLASHING}) if clashing else df


def rows_of(df, *columns):
    picked = df.select(*columns) if columns else df
    return sorted(map(tuple, picked.collect()), key=repr)


def ordered(rows):
    return sorted(rows, key=repr)
