"""Near duplicates by comparing all pairs of shingle sets."""

import re


def shingles(text, size=5):
    words = re.findall(r"[^\x20\x09-\x0D]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    if len(words) < size:
        return frozenset([" ".join(words)]) if words else frozenset()
    return frozenset(" ".join(words[i : i + size]) for i in range(len(words) - size + 1))


def near_duplicates(rows, percent=85):
    """Sorted (doc_id, n_shingles, component_id, kept) of rows (doc_id, text)."""
    sets = [shingles(text) for _, text in rows]
    parent = {s: s for s in sets}

    def root(s):
        while parent[s] != s:
            s = parent[s]
        return s

    different = sorted((s for s in parent if s), key=len)
    for i, a in enumerate(different):
        for b in different[i + 1 :]:
            if len(a) * 100 < len(b) * percent:
                break
            shared = len(a & b)
            if 100 * shared >= percent * (len(a) + len(b) - shared):
                parent[root(a)] = root(b)
    least = {}
    for (doc_id, _), s in zip(rows, sets):
        if s and doc_id is not None:
            least[root(s)] = min(doc_id, least.get(root(s), doc_id))
    out = []
    for (doc_id, _), s in zip(rows, sets):
        component = least.get(root(s)) if s else doc_id
        out.append((doc_id, len(s), component, doc_id == component))
    return sorted(out, key=str)
