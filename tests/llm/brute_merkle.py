"""The Merkle manifest built with plain lists."""

import hashlib
import zlib


def digest(text):
    return hashlib.sha256(text.encode()).hexdigest()


def field(value):
    return "-" if value is None else f"{len(str(value).encode())}:{value}"


def leaf(row, text):
    return digest("".join(map(field, (row["doc_id"], row["source"], row["lang"], row["n_chars"], text))))


def lower(text):
    return text and "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def tree(nodes):
    levels = [nodes]
    while len(levels[-1]) > 1:
        levels.append([digest("".join(levels[-1][i : i + 16])) for i in range(0, len(levels[-1]), 16)])
    return levels


def siblings(levels, place):
    path = []
    for level in levels[:-1]:
        first = place // 16 * 16
        path.append(("".join(level[first:place]), "".join(level[place + 1 : first + 16])))
        place //= 16
    return path


def manifest(rows):
    groups = {}
    for r in rows:
        groups.setdefault(r["source"], []).append(r)
    order = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    made = []
    for source in order:
        found = []
        for r in groups[source]:
            tampered = r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0
            found.append((r["doc_id"], leaf(r, r["text"]), leaf(r, lower(r["text"]) if tampered else r["text"])))
        found.sort(key=lambda x: (x[0] is not None, x[0] or 0, x[1], x[2]))
        made.append((found, tree([x[1] for x in found])))
    top = tree([levels[-1][0] for _, levels in made])
    out = []
    for k, (found, levels) in enumerate(made):
        for i, (doc_id, own, changed) in enumerate(found):
            path, folded = siblings(levels, i) + siblings(top, k), changed
            for left, right in path:
                folded = digest(left + folded + right)
            root = top[-1][0]
            out.append((doc_id, own, levels[-1][0], root, digest("".join(a + b for a, b in path)), folded, folded == root))
    return sorted(out, key=str)
