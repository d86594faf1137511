"""Structure repair against an exhaustive search and a plain programme."""

import hashlib
import itertools
import random
import re
import zlib

import pytest

from mercato.llm import chat_repair, queries
from tests.conftest import SF_SMALL

SCHEMA = "conv_id long, turn long, role string, text string"
EMPTY = hashlib.sha256(b"").hexdigest()


def damaged(rows):
    out = []
    for c, turn, role, text in rows:
        role, text = (" " if v is None else v for v in (role, text))
        name = f"{' ' if c is None else c}:{' ' if turn is None else turn}"
        x = zlib.crc32(name.encode()) % 20
        if x == 1:
            text = ""
        if x == 2:
            text = re.sub("[.!?]", "", text)
        if x == 4:
            role = "user"
        out += [(c, turn, role, text)] * (0 if x == 0 else 2 if x == 3 else 1)
    return out


def examined(rows):
    """conversation -> rows (turn, role, text, fault) in order."""
    convs = {}
    for c, turn, role, text in rows:
        convs.setdefault(c, []).append((turn, " " if role is None else role, " " if text is None else text))
    out = {}
    for c, turns in convs.items():
        turns.sort(key=lambda t: (t[0] is not None, t[0] or 0, t[1], t[2]))
        seen, done = set(), []
        for turn, role, text in turns:
            said = re.sub(r"[\x20\x09-\x0D]+\Z", "", text)
            fault = ("blank" if not said else "duplicate" if (role, text) in seen
                     else "truncated" if said[-1] not in ".!?" else None)
            seen.add((role, text))
            done.append((turn, role, text, fault))
        out[c] = done
    return out


def plain(rows):
    """Least (cost, audit) by a forward programme over what was written last; the lines too."""
    follow = {"": "u", "s": "u", "u": "a", "a": "u"}
    names = {"u": "user", "a": "assistant"}

    def inserts(states):
        for _ in range(2):
            for s, (cost, audit, lines) in list(states.items()):
                to = follow[s]
                new = (cost + 3, audit + "I", [*lines, names[to] + ":"])
                if to not in states or new < states[to]:
                    states[to] = new
        return states

    states = {"": (0, "", [])}
    for _, role, text, fault in rows:
        nxt = {}

        def offer(to, cost, audit, lines):
            if to not in nxt or (cost, audit) < nxt[to][:2]:
                nxt[to] = (cost, audit, lines)

        for s, (cost, audit, lines) in inserts(states).items():
            offer(s, cost + 4, audit + "D", lines)
            if fault in ("blank", "duplicate"):
                continue
            more = 3 if fault else 0
            i = role[:1]
            if (s, i) in {("", "s"), ("", "u"), ("s", "u"), ("a", "u"), ("u", "a")}:
                offer(i, cost + more, audit + "K", [*lines, f"{role}:{text}"])
            offer(follow[s], cost + more + 3, audit + "R", [*lines, f"{names[follow[s]]}:{text}"])
        states = nxt
    return min(v for s, v in inserts(states).items() if s in ("", "a"))


def brute(original, block=None):
    out = []
    rows = examined(damaged(original))
    for c in {r[0] for r in original}:
        turns = rows.get(c, [])
        cost, audit, lines = plain(turns)
        at = [t[0] for t in turns if t[0] is not None]
        gaps = max(at) - min(at) + 1 - len(set(at)) if at else 0
        count = [sum(t[3] == f for t in turns) for f in ("blank", "duplicate", "truncated")]
        illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in itertools.pairwise(turns))
        out.append((c, gaps, *count, illegal, cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest()))
    return sorted(out, key=str)


def exhaustive(symbols):
    """Least (cost, audit) over all edit strings of at most two inserts per gap."""
    best = None
    for gaps in itertools.product(range(3), repeat=len(symbols) + 1):
        for edits in itertools.product("DKR", repeat=len(symbols)):
            cost, audit, said, ok = 0, "", "", True
            for i in range(len(symbols) + 1):
                audit += "I" * gaps[i]
                cost += 3 * gaps[i]
                for _ in range(gaps[i]):
                    said += "a" if said.endswith("u") else "u"
                if i == len(symbols):
                    break
                symbol, edit = symbols[i], edits[i]
                ok &= symbol != "x" or edit == "D"
                audit += edit
                cost += {"D": 4, "K": 0, "R": 3}[edit] + (3 if symbol.isupper() and edit != "D" else 0)
                if edit != "D":
                    said += symbol.lower() if edit == "K" else "a" if said.endswith("u") else "u"
            if ok and re.fullmatch("(s?(ua)+)?", said) and (best is None or (cost, audit) < best):
                best = (cost, audit)
    return best


def by_runs(symbols):
    runs = [(s, len(list(g))) for s, g in itertools.groupby(symbols)]
    costs, state = chat_repair._END, 0
    for symbol, n in reversed(runs):
        costs = chat_repair.advance(symbol, n, costs)
    audit = ""
    for letters, state in chat_repair._edits(runs, chat_repair._END, 0):
        audit += letters
    while state in (1, 2):
        audit, state = audit + "I", chat_repair._NEXT[state]
    return costs[0], audit


@pytest.mark.parametrize("n", [0, 1, 2, 3])
def test_programme_is_exhaustive_search(n):
    for symbols in itertools.product("suaoUx" if n == 3 else "suaoSUAOx", repeat=n):
        assert by_runs("".join(symbols)) == exhaustive("".join(symbols)), symbols


def test_powers_are_single_steps():
    for symbol in "suaoSUAOx":
        costs = chat_repair._END
        for n in range(1, 40):
            costs = chat_repair.advance(symbol, 1, costs)
            assert costs == chat_repair.advance(symbol, n, chat_repair._END)
            pairs = list(chat_repair._row_costs(symbol, n, chat_repair._END))
            assert len(pairs) == n and pairs[0][0] == costs and pairs[-1][1] == chat_repair._END
            assert all(a[1] == b[0] for a, b in itertools.pairwise(pairs))


COLUMNS = ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]


def rows_of(df):
    return sorted((tuple(r) for r in df.select(*COLUMNS).collect()), key=str)


def test_query_equals_brute_force(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF_SMALL}/conversations.parquet")
            .select("conv_id", "turn", "role", "text").collect()]
    assert rows_of(queries.op12_structure_repair(spark, SF_SMALL)) == brute(rows)


def random_rows(seed):
    rnd = random.Random(seed)
    rows = []
    for c in [None, *range(40)]:
        for t in range(rnd.choice([1, 2, 5, 9, 30])):
            rows.append((c, None if rnd.random() < 0.05 else t + rnd.choice([0, 0, 0, 3]),
                         rnd.choice(["user", "assistant", "user", "assistant", "system", "tool", "", None]),
                         rnd.choice(["a.", "b!", "c", "", " \n", None, "d? ", "a."])))
    rnd.shuffle(rows)
    return rows


@pytest.mark.parametrize("seed,block", [(1, 4096), (2, 1), (3, 4), (4, 7)])
def test_random_conversations(spark, tmp_path, seed, block):
    """Nulls in every column, ties, repeated rows, unknown roles, blocks down to one row."""
    rows = random_rows(seed)
    spark.createDataFrame([(*r, "x", 1) for r in rows], SCHEMA + ", symbol string, pos int").repartition(4) \
        .write.parquet(f"{tmp_path}/conversations.parquet")
    df = spark.read.parquet(f"{tmp_path}/conversations.parquet")
    got = {r[0]: r for r in rows_of(chat_repair.report(chat_repair.damage(df), block))}
    for want in brute(rows):
        assert got.get(want[0], (want[0], 0, 0, 0, 0, 0, 0, "", EMPTY)) == want
    assert rows_of(queries.op12_structure_repair(spark, str(tmp_path))) == brute(rows)


def test_repaired_rows(spark):
    rows = random_rows(7)
    df = spark.createDataFrame(rows, SCHEMA)
    told = {r.conv_id: r for r in chat_repair.report(df, 5).collect()}
    lines = {}
    for r in sorted(chat_repair.repaired(df, 5).collect(), key=lambda r: r.position):
        lines.setdefault(r.conv_id, []).append(r)
    for c, report in told.items():
        said = lines.get(c, [])
        assert [r.position for r in said] == list(range(1, len(said) + 1))
        assert re.fullmatch("(s?(ua)+)?", "".join(r.role[0] for r in said))
        assert hashlib.sha256("\n".join(f"{r.role}:{r.text}" for r in said).encode()).hexdigest() \
            == report.repaired_sha256
        assert "".join(r.edit for r in said) == report.audit.replace("D", "")


def test_long_runs_and_empty_table(spark):
    rows = [(1, t, "user", f"{t}.") for t in range(5000)] + [(2, 0, "user", "x" * 200000)]
    got = {r.conv_id: r for r in chat_repair.report(spark.createDataFrame(rows, SCHEMA), 512).collect()}
    want = plain(examined(rows)[1])
    assert (got[1].cost, got[1].audit, got[1].illegal) == (*want[:2], 4999)
    assert got[2].audit == "D" and got[2].cost == 4
    assert chat_repair.report(spark.createDataFrame([], SCHEMA)).count() == 0
    assert chat_repair.repaired(spark.createDataFrame([], SCHEMA)).count() == 0
