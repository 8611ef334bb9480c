"""Plain versions of what the queries return."""

import hashlib
import math
import re
from collections import Counter
from itertools import accumulate, product

WORD = re.compile("[^\x20\x09-\x0d]+")


def quality_measures(text):
    text = text or ""
    words = WORD.findall(text)
    lines = [line for line in text.split("\n") if WORD.search(line)]
    windows = {}
    for i in range(len(words) - 7):
        windows.setdefault(tuple(words[i : i + 8]), []).append(i)
    covered = {i + k for places in windows.values() if len(places) > 1 for i in places for k in range(8)}
    measures = {
        "n_words": len(words),
        "word_chars": sum(map(len, words)),
        "n_symbols": sum(c in "#*$%&|<>" for c in text),
        "n_dup_lines": len(lines) - len(set(lines)),
        "n_repeat_words": len(covered),
    }
    failed = len(words) < 20 or 100 * len(covered) > 30 * len(words)
    return measures, failed


def shingles(text, width):
    words = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return set()
    width = min(width, len(words))
    return {tuple(words[i : i + width]) for i in range(len(words) - width + 1)}


def near_duplicates(texts, width, percent=80):
    """{id: (n_shingles, component)} of {id: text}, every pair that shares a shingle compared."""
    sets = {key: frozenset(shingles(text, width)) for key, text in texts.items()}
    same, parent = {}, {key: key for key in sets}

    def root(key):
        while parent[key] != key:
            key = parent[key]
        return key

    def join(a, b):
        a, b = sorted((root(a), root(b)))
        parent[b] = a

    for key, found in sorted(sets.items()):
        if found:
            join(same.setdefault(found, key), key)
    holders = {}
    for found, key in same.items():
        for shingle in found:
            holders.setdefault(shingle, []).append(key)
    for found, key in same.items():
        shared = {}
        for shingle in found:
            for other in holders[shingle]:
                if other < key:
                    shared[other] = shared.get(other, 0) + 1
        for other, both in shared.items():
            if 100 * both >= percent * (len(found) + len(sets[other]) - both):
                join(other, key)
    return {key: (len(found), root(key)) for key, found in sets.items()}


def edit_places(item, words):
    """Least edit distance (in words) of the item to any stretch of the words."""
    before = [0] * (len(words) + 1)
    for i, word in enumerate(item, start=1):
        row = [i]
        for j, other in enumerate(words, start=1):
            row.append(min(before[j - 1] + (word != other), before[j] + 1, row[j - 1] + 1))
        before = row
    return min(before)


def hard_negatives(rows, percent=80):
    """[(anchor, positive, rank, negative, positive's score, negative's score)] of (id, label, vector), all pairs scored."""
    taking = []
    for id, label, vector in rows:
        if id is None or label is None or vector is None:
            continue
        if any(x is None or x != x or abs(x) == float("inf") for x in vector):
            continue
        taking.append((id, (label + 1) % 10 if id % 7 == 0 else label, [math.floor(256 * x) for x in vector]))
    out = []
    anchors = {(id, label, tuple(vector)) for id, label, vector in taking if id % 100 == 0}
    for anchor, own, vector in sorted(anchors):
        scored = [
            (-sum(x * y for x, y in zip(vector, other, strict=False)), id, label)
            for id, label, other in taking
            if id != anchor
        ]
        positives = sorted((s, id) for s, id, label in scored if label == own)[:5]
        negatives = sorted((s, id) for s, id, label in scored if label != own)
        for top, positive in positives:
            inside = [(-s, id) for s, id in negatives if percent * -top <= 100 * -s <= 100 * -top][:5]
            out += [(anchor, positive, rank, id, -top, s) for rank, (s, id) in enumerate(inside, start=1)]
    return sorted(out)


def alignments(texts, encode_a, bytes_a, encode_b, bytes_b):
    """(n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256) of each text; whole texts encoded, every row counted."""
    found, counts = [], Counter()
    for text in texts:
        a, b = (encode_a(" " + text), encode_b(text)) if text else ([], [])
        parts = [[bytes_a(i) for i in a], [bytes_b(i) for i in b]]
        if not text or any(b"".join(part) != (" " + text).encode() for part in parts):
            found.append(([], "", 0, 0, 0))
            continue
        owners = [[i for i, token in enumerate(part) for _ in token] for part in parts]
        links = list(dict.fromkeys(zip(*owners, strict=True)))
        groups, first, last = [], (0, 0), [len(a), len(b)]
        ends = [set(accumulate(map(len, part))) for part in parts]
        for cut in sorted(ends[0] & ends[1]):
            last = [owner[cut - 1] + 1 for owner in owners]
            groups.append(
                ",".join(map(str, a[first[0] : last[0]])) + "|" + ",".join(map(str, b[first[1] : last[1]]))
            )
            first = last
        pairs = [(a[i], b[j]) for i, j in links]
        counts.update(pairs)
        digest = hashlib.sha256(";".join(groups).encode()).hexdigest()
        found.append((pairs, digest, len(a), len(b), len(groups)))
    most = {}
    for (_, b), count in counts.items():
        most[b] = max(most.get(b, 0), count)
    return [
        (n_a, n_b, n_groups, len(pairs), sum(counts[p] == most[p[1]] for p in pairs), sum(counts[p] for p in pairs), digest)
        for pairs, digest, n_a, n_b, n_groups in found
    ]


def markov_likelihood(first, moves, symbols, sequence):
    """The probability of a short sequence, all ways through the states added up."""
    total = 0.0
    for way in product(range(len(first)), repeat=len(sequence)):
        chance = first[way[0]]
        for i, (state, symbol) in enumerate(zip(way, sequence, strict=True)):
            chance *= symbols[symbol][state] * (moves[way[i - 1]][state] if i else 1)
        total += chance
    return total


def markov_counts(first, moves, symbols, sequence):
    """Expected counts of first states, moves and (symbol, state), all ways weighted by their share."""
    begun, moved, shown, whole = Counter(), Counter(), Counter(), 0.0
    for way in product(range(len(first)), repeat=len(sequence)):
        chance = first[way[0]]
        for i, (state, symbol) in enumerate(zip(way, sequence, strict=True)):
            chance *= symbols[symbol][state] * (moves[way[i - 1]][state] if i else 1)
        whole += chance
        begun[way[0]] += chance
        for one, other in zip(way, way[1:], strict=False):
            moved[one, other] += chance
        for state, symbol in zip(way, sequence, strict=True):
            shown[symbol, state] += chance
    return [{key: value / whole for key, value in counts.items()} for counts in (begun, moved, shown)]


def unigram_scores(texts, held_out):
    """(n_tokens, n_known, train_tokens, base_score) of each text."""
    words = [(text or "").encode().lower().split() + [None] for text in texts]
    counts = Counter(word for text, held in zip(words, held_out, strict=True) if not held for word in text)
    total, kinds = sum(counts.values()), len(counts)
    return [
        (
            len(text),
            sum(counts[word] > 0 for word in text),
            total,
            sum(math.log10((counts[word] + 0.1) / (total + 0.1 * (kinds + 1))) for word in text),
        )
        for text in words
    ]


VALUE = set("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_.=-")


def _run(text, at, allowed):
    end = at
    while end < len(text) and text[end] in allowed:
        end += 1
    return end


def base_secrets(text):
    """(start, end, kind) of the fixed patterns, matched character by character."""
    found, at = [], 0
    while at < len(text):
        end = None
        for word in ("password", "passwd", "secret", "token", "api_key", "apikey"):
            if "".join(c.lower() if c.isascii() else c for c in text[at : at + len(word)]) == word:
                i = at + len(word)
                i += text[i : i + 1] in ('"', "'") and i < len(text)
                i = _run(text, i, {" "})
                if text[i : i + 1] in (":", "=") and i < len(text):
                    i = _run(text, i + 1, {" "})
                    i += text[i : i + 1] in ('"', "'") and i < len(text)
                    end = _run(text, i, VALUE)
                    if end > i:
                        if end - i >= 6:
                            found.append((at, end, 0, "assign"))
                        break
                    end = None
        at = end or at + 1
    for first, allowed, least, order, kind in (
        ("AKIA", set("ABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789"), 20, 1, "access"),
        ("", set("0123456789abcdef"), 24, 2, "hex"),
    ):
        at = 0
        while at < len(text):
            if text.startswith(first, at):
                end = _run(text, at + len(first), allowed)
                if end > at + len(first):
                    if end - at >= least:
                        found.append((at, end, order, kind))
                    at = end
                    continue
            at += 1
    return [(start, end, kind) for start, end, order, kind in sorted(found, key=lambda f: (f[0], f[2]))]


def chosen_cutoffs(rows, chain, strata):
    """{rule: cutoff} of one stratum by exact binomials at a rate of 1/50 and an error of 1/20 over all strata.

    `rows` has the ratios of the stratum's good documents by rule. All in whole numbers.
    """
    cutoffs, n = {}, len(rows)
    for rule, cutoff in chain:
        tightened = {**cutoffs, rule: cutoff}
        k = sum(any(row[r] > c for r, c in tightened.items()) for row in rows)
        tail = sum(math.comb(n, i) * 49 ** (n - i) for i in range(k + 1)) if 50 * k < n else 50**n
        if not (50 * k < n and tail * 20 * strata <= 50**n):
            break
        cutoffs = tightened
    return cutoffs
