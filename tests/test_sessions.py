"""Pair builder and follow windows against a statement by positions, on
random sessions, and on literal ones."""

import datetime as dt
import random

from pyspark.sql import functions as F

from quarry.operators import sessions as W

SCHEMA = ("session_id string, ts_raw string, ts timestamp, ord long, role string, user_text string, "
          "assistant_text string, has_human boolean, human_text string")


def make_turns(seed, n_sessions=30, hot=400, null_ts=0.05):
    rng = random.Random(seed)
    rows = []
    o = 0
    base = dt.datetime(2024, 1, 1)
    for s in range(n_sessions):
        n = hot if s == 0 else rng.randint(0, 25)   # session 0 is a hot key
        t = base
        for _ in range(n):
            t = t + dt.timedelta(minutes=rng.choice([0, 1, 2, 5, 30, 90]))
            missing = rng.random() < null_ts
            ts_raw = None if missing else t.strftime("%Y-%m-%dT%H:%M:%S")
            role = rng.choice(["user", "user", "assistant", "assistant", "system"])
            human = role == "user" and rng.random() < 0.5
            htext = rng.choice(["", "short", "x" * 90, "y" * 120]) if human else ""
            utext = htext if human else (rng.choice(["", "[TOOL RESULT]\nout"]) if role == "user" else "")
            atext = rng.choice(["", "ans", "longer answer"]) if role == "assistant" else ""
            rows.append((f"s{s}", ts_raw, None if missing else t, o, role, utext, atext, human, htext))
            o += 1
    return rows


def ordered_sessions(rows):
    """Rows of each session in session order."""
    return [(sid, sorted((r for r in rows if r[0] == sid), key=lambda r: (r[1] or "", r[3]))) for sid in sorted({r[0] for r in rows})]


def islands(rs, starts):
    """Stretches of ``rs`` from each start to the next."""
    return [(a, rs[a:z]) for a, z in zip(starts, [*starts[1:], len(rs)])]


def expected_pairs(rows):
    """An answer takes the user texts since the previous answer, if any."""
    out = []
    for sid, rs in ordered_sessions(rows):
        answers = [i for i, r in enumerate(rs) if r[4] == "assistant" and r[6]]
        for previous, at in zip([-1, *answers], answers):
            users = [r[5] for r in rs[previous + 1:at] if r[4] == "user" and r[5]]
            out += [(sid, "\n\n".join(users).strip(), rs[at][6])] if users else []
    return sorted(out)


def expected_follow(rows, k, minutes, min_chars):
    """A human turn begins an island.  Its window: of the rows before the
    first late one, the first k that carry text."""
    out = []
    for sid, rs in ordered_sessions(rows):
        for _, island in islands(rs, [i for i, r in enumerate(rs) if r[4] == "user" and r[7]]):
            anchor, rest = island[0], island[1:]
            if len(anchor[8]) < min_chars:
                continue
            if minutes and anchor[2]:
                end = anchor[2] + dt.timedelta(minutes=minutes)
                late = [i for i, r in enumerate(rest) if r[2] is None or r[2] > end]
                rest = rest[:late[0]] if late else rest
            taken = [(r[4], r[6] if r[4] == "assistant" else r[5]) for r in rest if r[4] in ("user", "assistant")]
            taken = [t for t in taken if t[1]][:k]
            out += [(sid, anchor[8], tuple(taken))] if any(role == "assistant" for role, _ in taken) else []
    return sorted(out)


def test_pairs_match_islands(spark):
    rows = make_turns(1)
    df = spark.createDataFrame(rows, SCHEMA)
    for skew_safe in (True, False, "auto"):
        got = sorted((r["session_id"], r["user"], r["assistant"])
                     for r in W.build_pairs(df, skew_safe=skew_safe, hot_rows=100).collect())
        assert got == expected_pairs(rows)


def test_follow_match_islands(spark):
    rows = make_turns(2)
    df = spark.createDataFrame(rows, SCHEMA)
    for k, minutes, mode in ((3, 60, "auto"), (50, 0, True), (2, 5, False), (4, 30, True)):
        exp = expected_follow(rows, k, minutes, 80)
        res = W.follow_windows(df, follow_k=k, follow_minutes=minutes, min_user_chars=80,
                               skew_safe=mode, hot_rows=100)
        got = sorted((r["session_id"], r["messages"][1]["content"],
                      tuple((m["role"], m["content"]) for m in r["messages"][2:])) for r in res.collect())
        assert got == exp, (k, minutes, mode)


def test_partitioning_invariance(spark):
    rows = make_turns(3)
    df = spark.createDataFrame(rows, SCHEMA)
    base = sorted(tuple(r) for r in W.build_pairs(df).select("session_id", "user", "assistant").collect())
    for n in (1, 7):
        again = sorted(tuple(r) for r in W.build_pairs(df.repartition(n)).select(
            "session_id", "user", "assistant").collect())
        assert again == base


def test_limit_first_seen_order(spark):
    rows = make_turns(4, n_sessions=10, hot=20)
    df = spark.createDataFrame(rows, SCHEMA)
    seen = {}
    for r in rows:
        seen.setdefault(r[0], r[3])
    full = sorted((seen[r["session_id"]], r["island"]) for r in W.build_pairs(df).collect())
    for n in (1, 5, len(full) - 1, len(full), len(full) + 3):
        got = W.build_pairs(df, limit=n).collect()
        assert sorted((seen[r["session_id"]], r["island"]) for r in got) == full[:n]


def test_trailing_users_are_not_gathered(spark):
    """Users after the last answer leave before the texts are joined."""
    rows = [("s", f"{i:06d}", None, i, "user", f"u{i}", "", True, f"u{i}") for i in range(3000)]
    df = spark.createDataFrame(rows, SCHEMA)
    for mode in (True, False):
        assert W.build_pairs(df, skew_safe=mode).count() == 0


def test_naive_times_do_not_depend_on_the_zone(spark):
    from quarry.functions import text as T
    raw = ["2024-03-10T01:30:00", "2024-03-10T02:40:00", "20240310T024000", "2024-03-10 02:40", "2024", "12:00:00", " 2024-01-01 ", "2024-1-1"]
    df = spark.createDataFrame([(x,) for x in raw], "s string")
    got = []
    for zone in ("UTC", "America/New_York"):
        spark.conf.set("spark.sql.session.timeZone", zone)
        try:
            got.append([r[0] for r in df.select(F.unix_micros(T.parse_ts("s"))).collect()])
        finally:
            spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert got[0] == got[1] and got[0][1] - got[0][0] == 70 * 60_000_000
    assert got[0][2] == got[0][3] == got[0][1] and got[0][4:] == [None] * 4


def test_follow_limit_in_session_order(spark):
    rows = make_turns(6, n_sessions=12, hot=40)
    df = spark.createDataFrame(rows, SCHEMA)
    full = W.follow_windows(df, follow_k=5, follow_minutes=0, min_user_chars=80)
    first_seen = {}
    for r in rows:
        first_seen.setdefault(r[0], r[3])
    exp = sorted(((first_seen[r["session_id"]], r["island"]) for r in full.collect()))[:7]
    got = W.follow_windows(df, follow_k=5, follow_minutes=0, min_user_chars=80, limit=7).collect()
    assert sorted((first_seen[r["session_id"]], r["island"]) for r in got) == exp


def _rows(spec):
    """spec: (role, text, human, minute or None).  Rows are ordered by their
    position (``ts_raw``); ``ts`` is the event time used by the bound."""
    base = dt.datetime(2024, 1, 1)
    out = []
    for i, (role, text, human, minute) in enumerate(spec):
        ts = None if minute is None else base + dt.timedelta(minutes=minute)
        out.append(("s", f"2024-01-01T00:{i:02d}:00", ts, i, role,
                    text if role == "user" else "", text if role == "assistant" else "",
                    human, text if human else ""))
    return out


def test_pair_literals(spark):
    spec = [("assistant", "first, nothing pending", False, 0),
            ("user", "u1", True, 1), ("user", "u2", True, 2),
            ("assistant", "", False, 3),             # empty assistant keeps pending
            ("system", "other record", False, 4),
            ("assistant", "a1", False, 5),
            ("user", "trailing", True, 6)]
    df = spark.createDataFrame(_rows(spec), SCHEMA)
    got = [(r["user"], r["assistant"]) for r in W.build_pairs(df).collect()]
    assert got == [("u1\n\nu2", "a1")]


def test_follow_literals(spark):
    a = "x" * 90
    spec = [("user", a, True, 0),
            ("assistant", "at the bound", False, 3),     # ts == anchor + 3 min: kept
            ("user", "tool out", False, 3),
            ("error", "other type past the bound", False, 4),   # stops the window
            ("assistant", "too late", False, 4),
            ("user", "short", True, 5),                 # human turn, not an anchor
            ("assistant", "ignored", False, 5),
            ("user", a + "2", True, 6),
            ("assistant", "b1", False, 6), ("assistant", "b2", False, 6), ("assistant", "b3", False, 6),
            ("user", a + "3", True, 7)]                 # anchor with no assistant: no window
    df = spark.createDataFrame(_rows(spec), SCHEMA)
    res = W.follow_windows(df, follow_k=2, follow_minutes=3, min_user_chars=80).orderBy("island").collect()
    got = [[(m["role"], m["content"]) for m in r["messages"][1:]] for r in res]
    assert got == [[("user", a), ("assistant", "at the bound"), ("user", "tool out")],
                   [("user", a + "2"), ("assistant", "b1"), ("assistant", "b2")]]


def test_order_by_parsed_time(spark):
    # raw strings with mixed offsets: string order differs from time order
    rows = [("s", "2024-01-01T10:00:00+02:00", dt.datetime(2024, 1, 1, 8), 0, "user", "q1", "", True, "q1"),
            ("s", "2024-01-01T09:30:00+00:00", dt.datetime(2024, 1, 1, 9, 30), 1, "assistant", "", "a", False, "")]
    df = spark.createDataFrame(rows, SCHEMA)
    assert W.build_pairs(df).count() == 0                      # raw order: assistant first
    assert W.build_pairs(df, order_by="parsed").count() == 1   # time order: question first
