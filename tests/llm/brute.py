"""Plain Python versions of what the operators compute, for small inputs."""

import collections
import hashlib
import re

SPACES = " \t\n\x0b\x0c\r"


def sha(data):
    return hashlib.sha256(data if isinstance(data, bytes) else data.encode()).hexdigest()


def folded(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text)


def words(text):
    return [w for w in re.split("[ \t-\r]+", text or "") if w]


def shingles(text, width):
    found = words(folded(text or ""))
    if not found:
        return set()
    if len(found) < width:
        return {tuple(found)}
    return {tuple(found[k : k + width]) for k in range(len(found) - width + 1)}


def components(docs, width, percent):
    """{doc_id: (shingles, least id reachable)} by comparing all pairs that share a shingle."""
    sets = {i: shingles(t, width) for i, t in docs}
    holders, common = collections.defaultdict(list), collections.Counter()
    for i, found in sets.items():
        for shingle in found:
            holders[shingle].append(i)
    for ids in holders.values():
        for a in range(len(ids)):
            for b in range(a + 1, len(ids)):
                common[ids[a], ids[b]] += 1
    root = {i: i for i in sets}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for (a, b), n in common.items():
        if 100 * n >= percent * (len(sets[a]) + len(sets[b]) - n):
            low, high = sorted((find(a), find(b)))
            root[high] = low
    return {i: (len(sets[i]), find(i)) for i in sets}


def without_windows(docs, window):
    """Per row (words, kept words): words of windows that start twice or more go."""
    split = [words(t) for _, t in docs]
    seen = collections.Counter(tuple(w[s : s + window]) for w in split for s in range(len(w) - window + 1))
    found = []
    for w in split:
        gone = set()
        for s in range(len(w) - window + 1):
            if seen[tuple(w[s : s + window])] > 1:
                gone.update(range(s, s + window))
        found.append((len(w), [x for k, x in enumerate(w) if k not in gone]))
    return found


def without_lines(docs, least):
    """Per row (lines, kept lines)."""
    key = lambda line: folded(line.strip(SPACES))
    holders = collections.defaultdict(set)
    for i, t in docs:
        for line in (t or "").split("\n"):
            holders[key(line)].add((i, t))
    found = []
    for _, t in docs:
        split = (t or "").split("\n")
        found.append((len(split), [x for x in split if not key(x) or len(holders[key(x)]) < least]))
    return found


def measures(text):
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words."""
    text = text or ""
    found = words(text)
    windows = [tuple(found[k : k + 3]) for k in range(len(found) - 2)]
    counts = collections.Counter(windows)
    repeated = {k + j for k, w in enumerate(windows) if counts[w] > 1 for j in range(3)}
    seen, again = set(), 0
    for line in text.split("\n"):
        if words(line):
            again += line in seen
            seen.add(line)
    return len(found), sum(map(len, found)), sum(c in "#*$%&|<>" for c in text), again, len(repeated)
