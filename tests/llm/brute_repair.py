"""Conversation repair by a plain search over (cost, audit)."""

import hashlib
import re
import zlib

SPACE = " \t\n\x0b\x0c\r"
NEXT = {"": {"s": "s", "u": "u"}, "s": {"u": "u"}, "u": {"a": "a"}, "a": {"u": "u"}}
NAME = {"u": "user", "a": "assistant"}


def sha(text):
    return hashlib.sha256(text.encode("utf-8", "surrogatepass")).hexdigest()


def damaged(rows):
    out = []
    for conv, turn, role, text in rows:
        name = lambda x: " " if x is None else str(x)
        kind = zlib.crc32(f"{name(conv)}:{name(turn)}".encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        if kind == 1:
            text = ""
        if kind == 2:
            text = re.sub("[.!?]", "", text)
        if kind == 4:
            role = "user"
        out += [(conv, turn, role, text)] * {0: 0, 3: 2}.get(kind, 1)
    return out


def repaired(rows):
    """The answer for the rows (turn, role, text) of one conversation."""
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), sha(r[2])))
    seen, faults = set(), []
    for turn, role, text in rows:
        last = text.strip(SPACE)[-1:]
        faults.append("blank" if not last else "duplicate" if (role, text) in seen else "truncated" if last not in ".!?" else "")
        seen.add((role, text))
    # best[state] = (cost, audit, lines) of what follows
    best = {"": (0, "", []), "a": (0, "", [])}

    def insert(best):
        for _ in range(3):
            for q in NEXT:
                for c, to in NEXT[q].items():
                    if c in NAME and to in best:
                        cost, audit, lines = best[to]
                        best[q] = min(best.get(q, (10**9, "", [])), (cost + 3, "I" + audit, [NAME[c] + ":"] + lines))

    insert(best)
    for (turn, role, text), fault in zip(rows[::-1], faults[::-1]):
        now = {}
        for q in NEXT:
            options = [(best[q][0] + 4, "D" + best[q][1], best[q][2])] if q in best else []
            if fault not in ("blank", "duplicate"):
                more = 3 * (fault == "truncated")
                to = NEXT[q].get(role[:1])
                if to in best:
                    options.append((best[to][0] + more, "K" + best[to][1], [f"{role}:{text}"] + best[to][2]))
                for c, name in NAME.items():
                    to = NEXT[q].get(c)
                    if to in best:
                        options.append((best[to][0] + more + 3, "R" + best[to][1], [f"{name}:{text}"] + best[to][2]))
            if options:
                now[q] = min(options)
        best = now
        insert(best)
    turns = {t for t, _, _ in rows if t is not None}
    cost, audit, lines = best[""]
    pairs = [a[1][:1] + b[1][:1] for a, b in zip(rows, rows[1:])]
    return (
        max(turns) - min(turns) + 1 - len(turns) if turns else 0, faults.count("blank"), faults.count("duplicate"), faults.count("truncated"),
        sum(p not in ("su", "ua", "au") for p in pairs), cost, audit, sha("\n".join(lines)),
    )


def answer(rows):
    """The rows of the query for conversations (conv_id, turn, role, text)."""
    by = {r[0]: [] for r in rows}
    for conv, *rest in damaged(rows):
        by[conv].append(tuple(rest))
    return sorted(((conv, *repaired(mine)) for conv, mine in by.items()), key=str)
