"""Plain versions of operators that SQL cannot express, over lists of (doc_id, text, lang, source)."""

import math
import re
from itertools import combinations

import numpy as np
import xxhash

SPACES = r"[^\x20\x09-\x0D]+"
ANY = "<*>"


def found_words(text):
    return re.findall(SPACES, text or "")


def fingerprint(text):
    words = (text or "").encode().lower().split()
    shingles = [b" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))] if words else []
    hashes = [xxhash.xxh64_intdigest(s, seed=42) for s in shingles]
    return sum(1 << b for b in range(64) if sum(h >> b & 1 for h in hashes) * 2 > len(hashes))


def component_ids(docs, budget=4):
    """(fingerprint, smallest doc_id reachable) of each row."""
    prints = [fingerprint(d[1]) for d in docs]
    root = {p: p for p in prints}

    def of(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in combinations(sorted(root), 2):
        if (a ^ b).bit_count() <= budget:
            x, y = sorted((of(a), of(b)))
            root[y] = x
    least = {}
    for doc, p in zip(docs, prints, strict=True):
        if doc[0] is not None:
            least[of(p)] = min(doc[0], least.get(of(p), doc[0]))
    return [(p, least.get(of(p))) for p in prints]


def spark_hash(tokens):
    """Spark's xxhash64 of an array of strings, as a signed number."""
    seed = 42
    for token in tokens:
        seed = xxhash.xxh64_intdigest(token.encode(), seed=seed)
    return seed - (1 << 64) if seed >> 63 else seed


def dropped_lines(docs, least_docs=10, similarity=0.7, long_words=20, short_docs=100):
    """{(doc_id, text): numbers of the lines that go}."""
    leaves, keys = {}, {}
    for doc_id, text in ((d[0], d[1]) for d in docs if d[1] is not None):
        for at, line in enumerate(text.split("\n")):
            tokens = tuple(ANY if re.search("[0-9]", w) else w for w in found_words(line))
            if tokens and sum(w != ANY for w in tokens) >= similarity * len(tokens):
                leaves.setdefault((len(tokens), tokens[:2]), []).append((tokens, doc_id, text, at))
    for (size, _), lines in leaves.items():
        common = {}
        for tokens, *_ in lines:
            for place in enumerate(tokens):
                common[place] = common.get(place, 0) + 1
        least = short_docs if size <= 2 else 2 if size >= long_words else least_docs
        for tokens, *place in lines:
            keys.setdefault(("line", tokens, least), []).append(place)
            if size > 2:
                general = tuple(
                    w if w != ANY and common[at, w] >= least_docs else ANY for at, w in enumerate(tokens)
                )
                if sum(w != ANY for w in general) >= similarity * size:
                    keys.setdefault(("template", general, least_docs), []).append(place)
    gone = {}
    for (_, _, least), places in keys.items():
        if len({text for _, text, _ in places}) >= least:
            first = min((d for d, _, _ in places if d is not None), default=None)
            for doc_id, text, at in places:
                if doc_id != first:
                    gone.setdefault((doc_id, text), set()).add(at)
    return gone


def without_lines(docs, **limits):
    gone = dropped_lines(docs, **limits)
    out = []
    for doc in docs:
        at = gone.get(doc[:2])
        text = doc[1]
        if at:
            text = "\n".join(x for k, x in enumerate(text.split("\n")) if k not in at)
        out.append((doc[0], text, *doc[2:]))
    return out


def statistics(text):
    """n_words, word_chars, n_symbols, n_lines, n_dup_lines, n_repeat_words."""
    words = found_words(text)
    lines = [x for x in (text or "").split("\n") if re.search(SPACES, x)]
    starts = {}
    for i in range(len(words) - 7):
        starts.setdefault(tuple(words[i : i + 8]), []).append(i)
    hit = {p for at in starts.values() if len(at) > 1 for i in at for p in range(i, i + 8)}
    symbols = len(re.findall(r"[#*$%&|<>]", text or ""))
    return (len(words), sum(map(len, words)), symbols, len(lines),
            len(lines) - len(set(lines)), len(hit))


def base_failed(stats):
    return stats[0] < 20 or 100 * stats[5] > 30 * stats[0]


def verdicts(docs, least_rows=60, subset=0.75, steps=3, cutoff=35.89, middle=4.351,
             spread=(0.5, 0.15, 0.03, 0.1, 0.1)):
    """Whether each row is kept: base limits and minimum-covariance-determinant distances."""
    stats = [statistics(d[1]) for d in docs]
    rows = np.array(
        [
            (math.log1p(n), math.log1p(c / max(n, 1)), s / max(n, 1), d / max(lines, 1), r / max(n, 1))
            for n, c, s, lines, d, r in stats
        ]
    ).reshape(-1, 5)
    passed = [not base_failed(s) for s in stats]
    cells, languages = {}, {}
    for at, doc in enumerate(docs):
        if passed[at]:
            cells.setdefault((doc[2], doc[3]), []).append(at)
            languages.setdefault(doc[2], []).append(at)
    pools = {}
    for (lang, _), members in cells.items():
        if len(members) < least_rows:
            pools.setdefault(lang, []).extend(members)
    # A cell is judged by itself, else with the small cells of its language, else by the
    # language, else by all documents: by the first of these that is large enough.
    everything = [at for at in range(len(docs)) if passed[at]]
    fits = []
    for cell, members in cells.items():
        choices = (members, pools.get(cell[0], []), languages[cell[0]], everything)
        chosen = next((c for c in choices if len(c) >= least_rows), None)
        if chosen is not None:
            fits.append((chosen, members))
    kept = list(passed)

    def quantile(values, share):
        return np.sort(values)[max(0, math.ceil(share * len(values)) - 1)]

    for fitted, members in fits:
        x = rows[fitted]
        center = np.array([quantile(column, 0.5) for column in x.T])
        shape = np.diag(np.square(spread))

        def distances(x=x):
            apart = x - center
            return np.einsum("ij,jk,ik->i", apart, np.linalg.inv(shape), apart)

        for _ in range(steps):
            d = distances()
            inner = x[d <= quantile(d, subset)]
            center = inner.mean(axis=0)
            shape = np.cov(inner.T, bias=True) + np.diag(np.square(spread))
        scale = max(quantile(distances(), 0.5) / middle, 1.0)
        for at, far in zip(members, distances(rows[members]) / scale, strict=True):
            kept[at] = bool(far <= cutoff)
    return kept


TEST_WORD = re.compile(rb"[0-9a-z\x80-\xff]+")


def hit_places(text, windows):
    """(spans of the words, set of word numbers inside a window)."""
    places = [m.span() for m in TEST_WORD.finditer(text.encode().lower())]
    raw = text.encode().lower()
    words = [raw[i:j] for i, j in places]
    hit = set()
    for size in {len(w) for w in windows}:
        for i in range(len(words) - size + 1):
            if tuple(words[i : i + size]) in windows:
                hit.update(range(i, i + size))
    return places, hit


def cleaned(docs, items, window=10, limit=0.5):
    windows = set()
    for text in items:
        words = TEST_WORD.findall((text or "").encode().lower())
        if words:
            size = min(window, len(words))
            windows |= {tuple(words[i : i + size]) for i in range(len(words) - size + 1)}
    out = []
    for doc in docs:
        text = doc[1]
        places, hit = hit_places(text or "", windows)
        if len(hit) > limit * max(1, len(places)):
            continue
        if hit:
            raw, kept, done = text.encode(), [], 0
            for k, (i, j) in enumerate(places):
                if k in hit:
                    # The gap before a run stays; gaps inside a run go with it.
                    if k - 1 not in hit:
                        kept.append(raw[done:i])
                    done = j
            text = b"".join([*kept, raw[done:]]).decode()
        out.append((doc[0], text, *doc[2:]))
    return out
