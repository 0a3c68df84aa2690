"""Plain-Python versions of the operators, for small inputs."""

import re
from collections import Counter


def shingles(text, k):
    w = [x.decode() for x in (text or "").encode().lower().split()]
    return {tuple(w[i:i + min(k, len(w))]) for i in range(max(1, len(w) - k + 1))} if w else set()


def near_duplicates(rows, k=5, percent=80):
    """[(doc_id, n_shingles, component_id, kept)] of (doc_id, text) rows, all pairs compared."""
    sets = [shingles(t, k) for _, t in rows]
    comp = list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and sets[j]:
                common = len(sets[i] & sets[j])
                if 100 * common >= percent * (len(sets[i]) + len(sets[j]) - common):
                    a, b = comp[i], comp[j]
                    comp = [min(a, b) if c in (a, b) else c for c in comp]
    least = {}
    for (d, _), c in zip(rows, comp):
        least[c] = d if least.get(c) is None else least[c] if d is None else min(d, least[c])
    return sorted(((d, len(s), least[c], d == least[c]) for (d, _), s, c in zip(rows, sets, comp)), key=str)


def plain_words(text):
    return re.findall(r"[^\W_]+", (text or "").lower())


def weighted_similarity(a, b, k=5):
    def multiset(w):
        return Counter(tuple(w[i:i + min(k, len(w))]) for i in range(max(1, len(w) - k + 1)))
    x, y = multiset(a), multiset(b)
    return sum((x & y).values()) / sum((x | y).values())


def contains(doc, item, similarity=0.8):
    d, i = plain_words(doc), plain_words(item)
    if not d or not i:
        return False
    n = min(len(i), len(d))
    return any(weighted_similarity(d[s:s + n], i, min(5, n)) >= similarity for s in range(len(d) - n + 1))


def line_templates(rows, leading=3, min_docs=10, min_tokens=3, percent=75, least=4, core=2, whole=(2, 6), units=None):
    """{(doc_id, line_no): (n_docs, dropped)} for (doc_id, text) rows with distinct ids, as the module describes it."""
    unit = {d: (units or {}).get(d, d) for d, _ in rows}
    lines, sharers = {}, {}
    for d, t in rows:
        for i, line in enumerate((t or "").split("\n")):
            tokens = tuple(None if any(c.isdigit() for c in w) else w for w in line.lower().split())
            if len(tokens) >= min_tokens:
                lines[d, i] = tokens
                sharers.setdefault(tokens, set()).add(unit[d])
    leaves = {}
    for tokens in sharers:
        leaves.setdefault((len(tokens), tokens[:leading]), []).append(tokens)
    found = {}                                       # distinct line -> (documents, the one that keeps it)
    for members in leaves.values():
        if len(set().union(*(sharers[t] for t in members))) < min_docs:
            continue
        support = Counter()
        for t in members:
            for place in enumerate(t):
                support[place] += len(sharers[t])
        templates = {}
        for t in members:
            known = [(support[i, w], i, w) for i, w in enumerate(t) if w is not None and support[i, w] >= min_docs]
            words = sum(w is not None for w in t)
            need = max(min(words, max(least, -(-words * percent // 100))), min(core, len(t)))
            if len(known) >= need:
                bar = sorted(known, reverse=True)[need - 1][0]
                templates.setdefault(frozenset((i, w) for s, i, w in known if s >= bar), []).append(t)
        for same in templates.values():
            docs = set().union(*(sharers[t] for t in same))
            if len(docs) >= min_docs:
                found.update((t, (len(docs), min(docs))) for t in same)
    for t, docs in sharers.items():
        if t not in found and len(docs) >= whole[0] and sum(w is not None for w in t) >= whole[1]:
            found[t] = (len(docs), min(docs))
    return {(d, i): (found[t][0], unit[d] != found[t][1]) for (d, i), t in lines.items() if t in found}


def phrases(text, reference):
    """Greedy longest-match parse of symbol strings, by plain search."""
    n = i = 0
    while i < len(text):
        j = i + 1
        while j <= len(text) and text[i:j] in reference:
            j += 1
        i, n = max(i + 1, j - 1), n + 1
    return n
