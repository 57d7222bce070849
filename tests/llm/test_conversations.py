import hashlib
import itertools
import random
import re
import zlib
from functools import cache

import pytest

from tickloom.llm import conversations as C


def cheapest(rows):
    """Cost and least audit string by full recursion over strings, for rows (role, kind flags must_go, cut)."""
    due = {"": "u", "s": "u", "u": "a", "a": "u"}
    after = {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("a", "u"): "u", ("u", "a"): "a"}

    @cache
    def best(i, state, inserted):
        options = []
        if i == len(rows) and state in ("", "a"):
            options.append((0, ""))
        if inserted < 3:
            c, s = best(i, due[state], inserted + 1)
            options.append((c + 3, "I" + s))
        if i < len(rows):
            role, must_go, cut = rows[i]
            c, s = best(i + 1, state, 0)
            options.append((c + 4, "D" + s))
            if not must_go:
                c, s = best(i + 1, due[state], 0)
                options.append((c + 3 + 3 * cut, "R" + s))
                if (state, role[:1]) in after:
                    c, s = best(i + 1, after[state, role[:1]], 0)
                    options.append((c + 3 * cut, "K" + s))
        return min(options, default=(10**9, ""))

    return best(0, "", 0)


def expected(rows):
    """The query's row for each conversation, from (conv_id, turn, role, text)."""
    out = []
    for conv in {r[0] for r in rows}:
        own = []
        for _, turn, role, text in (r for r in rows if r[0] == conv):
            key = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
            k = zlib.crc32(key.encode()) % 20
            text, role = " " if text is None else text, " " if role is None else role
            text = "" if k == 1 else re.sub("[.!?]", "", text) if k == 2 else text
            own += [(turn, "user" if k == 4 else role, text)] * (0 if k == 0 else 2 if k == 3 else 1)
        digest = lambda r: hashlib.md5(f"{len(r[1])}:{r[1]}{r[2]}".encode()).hexdigest()
        own.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2][:64], digest(r)))
        turns = [r[0] for r in own if r[0] is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        n, seen, flags = {"blank": 0, "duplicate": 0, "truncated": 0}, set(), []
        for _, role, text in own:
            bare = re.sub(r"[\x20\x09-\x0D]+\Z", "", text)
            fault = "blank" if not bare else "duplicate" if (role, text) in seen else "truncated" if bare[-1] not in ".!?" else None
            seen.add((role, text))
            flags.append((role, fault in ("blank", "duplicate"), fault == "truncated"))
            if fault:
                n[fault] += 1
        illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in itertools.pairwise(own))
        cost, audit = cheapest(tuple(flags))
        i, state, lines = 0, "", []
        for e in audit:
            due = "assistant" if state == "u" else "user"
            if e == "D":
                i += 1
                continue
            role, text = (due, "") if e == "I" else (due if e == "R" else own[i][1], own[i][2])
            i += e != "I"
            state = role[:1]
            lines.append(f"{role}:{text}")
        out.append((conv, gaps, *n.values(), illegal, cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest()))
    return sorted(map(str, out))


def rows(seed=0, convs=120):
    r = random.Random(seed)
    texts = ["Fine.", "Fine!", "cut off", "", " \t\n", "Why?", "ends late. ", "x\x85", None, "two\nlines.", "same", "A." * 200]
    roles = ["user", "assistant", "system", "tool", "", None, "User", "s", "user", "assistant", "user", "assistant"]
    out = [(c, r.choice([i, i, i, r.randrange(12), None]), r.choice(roles), r.choice(texts) if r.random() < 0.6 else f"own {i}.") for c in range(convs) for i in range(r.randrange(1, 13))]
    out += [(None, i, "user", "Null.") for i in range(3)] + [(None, None, None, None), (-5, 0, "system", "Only."), (500, 3, "user", "Same."), (500, 3, "user", "Same."), (500, 9, "user", "Same."), (501, None, "assistant", "a."), (501, None, "user", "b.")]
    return out + [(502, i, ("user", "assistant")[i % 2], f"long {i}{'.' if i % 7 else ''}") for i in range(150)] + [(503, 1, "user", "q?")] * 40


SCHEMA = "conv_id long, turn long, role string, text string"


@pytest.mark.parametrize("block_rows", [C.BLOCK_ROWS, 5, 1])
def test_equals_brute_force(spark, block_rows):
    data = rows()
    df = spark.createDataFrame(data, SCHEMA)
    got = C.digests(C.repair(C.damaged(df), "copies", block_rows)).collect()
    assert sorted(map(str, map(tuple, got))) == expected(data)


def test_real_conversations(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/conversations.parquet")
    got = C.digests(C.repair(C.damaged(df), "copies")).collect()
    assert sorted(map(str, map(tuple, got))) == expected([tuple(r) for r in df.select("conv_id", "turn", "role", "text").collect()])


def test_every_short_conversation():
    """All rows of up to four kinds, alone and cut into blocks, against strings."""
    role = ("system", "user", "assistant", "tool")
    for n in range(5):
        for kinds in itertools.product((0, 1, 2, 3, 5, 6, 8), repeat=n):
            want = cheapest(tuple((role[k % 4], k == 8, bool(k & 4)) for k in kinds))
            layer, total, trail = C.forward(list(kinds), C.entry(0))
            state, cost = C.last_state(layer)
            assert (total + cost, "".join(C.backward(trail, state)[0]) + "I" * C.ENDS[state]) == want
            ways, cost = C.through_blocks([C.between_states(list(kinds[i : i + 2])) for i in range(0, n, 2)])
            audit = "".join("".join(C.backward(C.forward(list(kinds[2 * i : 2 * i + 2]), C.entry(x))[2], y)[0]) for i, (x, y) in enumerate(ways))
            assert (cost, audit + "I" * C.ENDS[ways[-1][1] if ways else 0]) == want


def test_repaired_turns_and_other_columns(spark):
    df = spark.createDataFrame([(1, 0, "system", "Be kind.", "x"), (1, 1, "assistant", "Hello.", "y")], SCHEMA + ", seen string")
    r = C.repair(df).collect()
    assert len(r) == 1 and [tuple(t) for t in r[0]["turns"]] == [("system", "Be kind."), ("user", ""), ("assistant", "Hello.")] and (r[0]["audit"], r[0]["cost"]) == ("KIK", 3)


def test_empty_table(spark):
    assert C.digests(C.repair(spark.createDataFrame([], SCHEMA))).count() == 0
