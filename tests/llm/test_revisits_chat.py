"""Revisit resolution and chat formatting against plain loops."""

import hashlib
import random
from datetime import datetime, timedelta

import duckdb
import pytest

from scripts.oracle_check import frame_hash
from statmart.llm import chatlog, revisits

RECORDS = ("record_id long, type string, url string, ts timestamp, status int, etag string, last_modified string, "
           "digest string, headers map<string,string>, key string, outcome string, part int")
T0 = datetime(2024, 1, 1)


def records(spark, rows):
    return spark.createDataFrame([(*r, "k", "o", 1) for r in rows], RECORDS)


@pytest.mark.parametrize("url,want", [
    ("HTTP://WWW.Example.com:80/a/?utm_source=x&b=2&a=1#frag", "example.com/a?a=1&b=2"),
    ("https://example.com", "example.com"), ("https://example.com/", "example.com"),
    ("https://www2.example.com:443/x//", "example.com/x"), ("http://example.com?b", "example.com?b"),
    ("http://example.com:8080/", "example.com:8080"), ("not a url#x", "not a url"), (None, None), ("", ""),
])
def test_canonical_url(spark, url, want):
    df = spark.createDataFrame([(url,)], "u string")
    assert df.select(revisits.canonical_url(df.u)).first()[0] == want


def test_resolution_cases(spark):
    def at(n):
        return T0 + timedelta(seconds=n)

    rows = [
        (1, "response", "http://a.com/", at(10), 200, '"1"', "d1", "x", {"Server": "s", "ETag": "old", "server": "t"}),
        (2, "response", "http://a.com/", at(20), 200, '"2"', None, "y", None),
        (3, "response", "http://a.com/", at(20), 200, '"3"', None, "z", {"a": "b"}),
        (4, "response", "http://a.com/", at(25), 404, '"9"', None, "q", {}),
        (5, "response", "http://n.com/", None, 200, '"1"', None, "q", {}),
        (10, "revisit", "https://www.a.com", at(10), 304, '"1"', None, None, {}),       # not strictly later
        (11, "revisit", "https://www.a.com", at(11), 304, 'W/"1"', "other", None, {"ETAG": "new", "X": "no"}),
        (12, "revisit", "https://a.com#f", at(30), 304, '"3"', None, None, None),       # tie: largest id
        (13, "revisit", "https://a.com#f", at(30), 304, '"2"', None, None, None),
        (14, "revisit", "https://a.com#f", at(15), 304, None, "d1", None, {}),
        (15, "revisit", "https://a.com#f", at(15), 304, None, None, None, {}),
        (16, "revisit", "https://a.com#f", at(15), 304, '"1"', None, "bad", {}),
        (17, "revisit", None, at(15), 304, '"1"', None, None, {}),
        (18, "revisit", "http://n.com", at(15), 304, '"1"', None, None, {}),
        (19, "revisit", "http://a.com", None, 304, '"1"', None, None, {}),
        (20, "revisit", "http://a.com", at(16), 304, '"1"', None, "x", {}),
        (20, "revisit", "http://a.com", at(16), 304, '"1"', None, "x", {}),             # repeated row
    ]
    out = sorted((r["record_id"], r["outcome"], r["refers_to"]) for r in revisits.resolve_revisits(records(spark, rows)).collect())
    assert out == [(10, "no_response", None), (11, "resolved", 1), (12, "resolved", 3), (13, "mismatch", None),
                   (14, "resolved", 1), (15, "no_validator", None), (16, "mismatch", None), (17, "no_response", None),
                   (18, "no_response", None), (19, "no_response", None), (20, "resolved", 1), (20, "resolved", 1)]
    merged = {r["record_id"]: r["headers"] for r in revisits.resolve_revisits(records(spark, rows)).collect()}
    assert merged[11] == {"server": "s", "etag": "new"} and merged[12] == {"a": "b"} and merged[13] is None
    assert revisits.resolve_revisits(records(spark, [])).count() == 0


def test_a_hot_url_is_carried_over_partitions(spark):
    rnd = random.Random(6)
    rows, want, latest = [], {}, None
    for i in range(3000):
        if rnd.random() < 0.01:
            rows.append((i, "response", "http://hot.com/x", T0 + timedelta(seconds=i), 200, f'"{i}"', None, str(i), {}))
            latest = i
        else:
            told = latest if rnd.random() < 0.8 else -1
            rows.append((i, "revisit", "http://hot.com/x", T0 + timedelta(seconds=i), 304, f'"{told}"', None, None, {}))
            want[i] = ("no_response", None) if latest is None else \
                ("resolved", latest) if told == latest else ("mismatch", None)
    rnd.shuffle(rows)
    got = revisits.resolve_revisits(records(spark, rows)).collect()
    assert {r["record_id"]: (r["outcome"], r["refers_to"]) for r in got} == want


def test_revisit_query_matches_sql(spark):
    sf = "/root/testdata/sf0.001"
    con = duckdb.connect()
    con.sql(f"CREATE VIEW pages AS SELECT * FROM read_parquet('{sf}/pages.parquet')")
    got, want = revisits.op1_revisits(spark, sf).toPandas(), con.sql(revisits.OP1_SQL).df()
    assert sorted(got.columns) == sorted(want.columns) and len(got) == len(want)
    assert frame_hash(got) == frame_hash(want)


TEXTS = [chatlog.PROBE, "", None, "a\\b\\l\\h\\c: x", "### User: hi </turn>\n", " </turn>\n </turn>", "plain\n\ntext", "é🙂" * 900,
         "\\", "\\\\", "#<\\", "x" * 70_000]
ROLES = ["user", "assistant", "system", "tool", "User", "\\rUser", "a: b", "x\n### y", "", None]


def conversations(spark, rows):
    return spark.createDataFrame([(*r, "p", 3) for r in rows],
                                 "conv_id long, turn long, role string, text string, parts string, block int")


def test_conversations_round_trip(spark):
    rnd = random.Random(8)
    rows = [(c, t, rnd.choice(ROLES), rnd.choice(TEXTS)) for c in range(40) for t in range(rnd.randint(1, 9))]
    rows += [(900, t, rnd.choice(ROLES[:3]), f"turn {t}") for t in range(700)]  # one long conversation
    rows += [(901, 0, "user", "same")] * 3 + [(902, None, "user", "first"), (902, -5, "assistant", "next")]
    rows += [(None, 0, "assistant", "no conversation")]
    shuffled = rows[:]
    rnd.shuffle(shuffled)
    out = chatlog.parse(chatlog.render(chatlog.fold_events(chatlog.as_events(conversations(spark, shuffled))))).collect()
    want = {}
    key = lambda r: (r[1] is not None, r[1] or 0, r[2] or "", hashlib.sha256((r[3] or "").encode()).hexdigest())
    for r in sorted(rows, key=key):
        want.setdefault(r[0], []).append((r[2] or "", r[3] or ""))
    assert {r["conv_id"]: [tuple(t) for t in r["turns"]] for r in out} == want
    for r in out:
        assert r["loss_text"] == "".join(t for role, t in want[r["conv_id"]] if role == "assistant")
        assert r["formatted"].count("</turn>") == len(want[r["conv_id"]])
    assert chatlog.render(chatlog.fold_events(chatlog.as_events(conversations(spark, [])))).count() == 0


def test_events_fold(spark):
    log = [
        (1, 1, 5, "delta", 2, None, "b"), (1, 1, 4, "delta", 2, None, "a"), (1, 1, 1, "delta", 1, None, "old"),
        (1, 1, 0, "start", 0, "assistant", None), (1, 1, 3, "regenerate", 2, None, None), (1, 1, 6, "delta", 2, None, None),
        (1, 2, 0, "start", 0, "user", None), (1, 2, 1, "delta", 0, None, "x"), (1, 2, 2, "edit", 0, None, "y"),
        (1, 2, 3, "edit", 0, None, "z"), (1, 2, 4, "delta", 0, None, "!"),
        (1, 3, 1, "delta", 0, None, "no start"), (1, 4, 0, "start", 0, "user", None),
        (1, 5, 0, "start", 0, "user", None), (1, 5, 1, "edit", 0, None, None),
        (1, 6, 1, "edit", 0, None, "gone"), (1, 6, 2, "regenerate", 1, None, None),
    ]
    events = spark.createDataFrame(log, "conv_id long, message_id long, seq long, kind string, attempt int, role string, text string")
    got = sorted((r["message_id"], r["role"], r["text"]) for r in chatlog.fold_events(events).collect())
    assert got == [(1, "assistant", "ab"), (2, "user", "z!"), (3, "", "no start"), (4, "user", ""), (5, "user", ""),
                   (6, "", "")]


def test_chat_query(spark):
    sf = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    rows += [(-7, 0, "user", chatlog.PROBE), (-7, 1, "assistant", chatlog.PROBE)]
    want = {}
    for c, _, role, text in sorted(rows):
        want.setdefault(c, []).append((role, text or ""))
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    out = chatlog.op5_chat_format(spark, sf).collect()
    assert len(out) == len(want)
    for r in out:
        loss = "".join(t for role, t in want[r["conv_id"]] if role == "assistant")
        assert (r["n_turns"], r["turns_sha256"], r["loss_chars"], r["loss_sha256"]) == (
            len(want[r["conv_id"]]), sha("".join(f"{a}\n{b}\n" for a, b in want[r["conv_id"]])), len(loss), sha(loss))
