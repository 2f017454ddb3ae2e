import hashlib
import itertools
import random
import re
import zlib

import pytest
from pyspark.sql import functions as F

from attesta.llm import turn_repair as t

WORD = re.compile("[^\x20\x09-\x0d]")


def damaged(rows):
    """Rows after damage, row by row in plain Python; conversations without rows stay as keys."""
    out = {}
    for conv, turn, role, text in rows:
        kept = out.setdefault(conv, [])
        role, text = " " if role is None else role, " " if text is None else text
        lot = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        if lot == 0:
            continue
        text = "" if lot == 1 else re.sub("[.!?]", "", text) if lot == 2 else text
        row = (turn, "user" if lot == 4 else role, text)
        kept += [row] * (2 if lot == 3 else 1)
    return {c: sorted(v, key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2])) for c, v in out.items()}


def faults(rows):
    seen, out = set(), []
    for _, role, text in rows:
        words = WORD.findall(text)
        out.append("blank" if not words else "duplicate" if (role, text) in seen else "truncated" if words[-1] not in ".!?" else "")
        seen.add((role, text))
    return out


def plain(rows):
    """Least (cost, audit) and the repaired turns, by a table over whole prefixes: no stack, no bounds, no pieces."""
    best = {"": (0, "", ())}  # last two initials of the repaired part -> cost, audit, turns

    def legal(roles):
        return re.fullmatch("s?(ua)*u?", roles)

    def put(table, roles, entry):
        key = roles[-2:] if len(roles) > 1 else roles
        if key not in table or entry[:2] < table[key][:2]:
            table[key] = entry

    def inserted(table):
        for _ in range(2):
            for key, (cost, audit, turns) in list(table.items()):
                for name in ("user", "assistant"):
                    roles = "".join(x[0] for x in turns) + name[0]
                    if legal(roles):
                        put(table, roles, (cost + 3, audit + "I", (*turns, name + ":")))
        return table

    for (turn, role, text), fault in zip(rows, faults(rows)):
        now = {}
        for cost, audit, turns in inserted(best).values():
            roles, late = "".join(x[0] for x in turns), 3 * (fault == "truncated")
            put(now, roles, (cost + 4, audit + "D", turns))
            if fault in ("blank", "duplicate"):
                continue
            for edit, price, name in (("K", 0, role), ("R", 3, "user"), ("R", 3, "assistant")):
                if legal(roles + (name[:1] or "?")):
                    put(now, roles + name[:1], (cost + price + late, audit + edit, (*turns, f"{name}:{text}")))
        best = now
    ends = [e for e in inserted(best).values() if re.fullmatch("(s?(ua)+)?", "".join(x[0] for x in e[2]))]
    return min(ends)


def wanted(rows):
    out = []
    for conv, kept in damaged(rows).items():
        f, turns = faults(kept), [r[0] for r in kept if r[0] is not None]
        cost, audit, left = plain(kept)
        illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(kept, kept[1:]))
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        sha = hashlib.sha256("\n".join(left).encode()).hexdigest()
        out.append((conv, gaps, f.count("blank"), f.count("duplicate"), f.count("truncated"), illegal, cost, audit, sha))
    return sorted(out, key=repr)


def got(df, **kw):
    return sorted((tuple(r) for r in t.repair(t.damage(df), **kw).collect()), key=repr)


def frame(spark, rows):
    return spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")


def test_table(table):
    df = table("conversations")
    assert got(df) == wanted([tuple(r) for r in df.select("conv_id", "turn", "role", "text").collect()])


def random_rows(seed, convs, most):
    rng = random.Random(seed)
    return [(c, rng.choice([k, k, k, None, k - 1]), rng.choice(["user", "assistant", "system", "tool", None, "", "a"]), rng.choice(["", " \t", "Yes.", "No", "Well!  ", None, "x?", "y"]))
            for c in range(convs) for k in range(rng.randint(1, most))]


@pytest.mark.parametrize("piece", [1, 3, 256])
def test_random_conversations_in_pieces_of_any_size(spark, piece):
    rows = random_rows(piece, 25, 9) + [(100, k, r, f"{k % 7}{e}") for k, (r, e) in enumerate(itertools.islice(itertools.cycle(itertools.product(
        ["user", "user", "system", "assistant", "assistant"], [".", ""])), 90))]
    assert got(frame(spark, rows), piece=piece) == wanted(rows)


def test_awkward_rows(spark):
    rows = [(None, 1, "user", "Hi."), (None, None, None, None), (1, None, "user", "Hi."), (1, None, "user", "Hi."), (2, 0, "system", "é ß\x00."),
            (3, 5, "user", "a. " * 50_000), (3, 6, "assistant", "ok."), (3, 9, "user", "\n")] + [(4, 1, "user", "same.")] * 40
    df = frame(spark, rows)
    for name in ("h", "copies", "present", "first", "head", "lot", "part", "piece"):
        df = df.withColumn(name, F.lit("clash"))
    assert got(df) == wanted(rows)
    assert got(df.limit(0)) == []
    dropped = [(7, k, "user", "x.") for k in range(200) if zlib.crc32(f"7:{k}".encode()) % 20 == 0]
    assert got(frame(spark, dropped)) == [(7, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())]


def test_search_needs_no_tight_bounds():
    rng = random.Random(5)
    for _ in range(200):
        items = [t.Item(0, rng.choice("usa?"), rng.random() < 0.3) if rng.random() < 0.8 else t.Item(rng.randint(1, 3)) for _ in range(rng.randint(0, 7))]
        loose = [[0] * 4 for _ in range(len(items) + 1)]
        assert t.search(items) == t.search(items, bounds=loose)


def test_long_conversation_stays_linear():
    items = [t.Item(0, c, k % 3 == 0) for k, c in enumerate("uusauaas" * 300)]
    best = t.search(items[:256])
    ways = t._ways(items[:256])
    assert best == min(w for s, e, *w in ways for w in [t.Best(*w)] if s == t.START and e in t.DONE)
