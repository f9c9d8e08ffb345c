"""Merkle manifest, periodic runs and chat formatting against brute-force versions and round trips."""

import hashlib
import random
import zlib
from collections import defaultdict

import pyarrow.parquet as pq
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from test_llm_brute import EDGE_TEXTS, LOW, SF, WORD, frame, same
from tidesync.llm import chat, merkle, periodic

FIELDS = ["doc_id", "source", "lang", "n_chars", "text"]
DOCS = "doc_id long, text string, lang string, source string, n_chars long, rank string, tree string, digest string"


# ---------------------------------------------------------------- op11

def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def brute_leaf(row):
    values = [None if row[f] is None else str(row[f]) for f in FIELDS]
    return h(*["-" if v is None else f"{len(v.encode())}:{v}" for v in values])


def brute_tree(leaves):
    """(root, per leaf the list of (place, others) up to it)"""
    paths, at = [[] for _ in leaves], list(range(len(leaves)))
    while len(leaves) > 1:
        runs = [leaves[i:i + 8] for i in range(0, len(leaves), 8)]
        for i, a in enumerate(at):
            run = runs[a // 8]
            paths[i].append((a % 8, run[:a % 8] + run[a % 8 + 1:]))
            at[i] = a // 8
        leaves = [h(*r) for r in runs]
    return leaves[0], paths


def brute_manifest(rows):
    langs = defaultdict(list)
    for r in rows:
        langs[r["lang"]].append(r)
    names = sorted(langs, key=lambda n: (n is not None, (n or "").encode()))
    trees = {}
    for n in names:
        langs[n].sort(key=lambda r: (r["doc_id"] is not None, r["doc_id"] or 0, brute_leaf(r)))
        trees[n] = brute_tree([brute_leaf(r) for r in langs[n]])
    root, outer = brute_tree([trees[n][0] for n in names]) if names else (None, [])
    out = []
    for n, above in zip(names, outer, strict=True):
        for r, path in zip(langs[n], trees[n][1], strict=True):
            whole = path + above
            changed = dict(r)
            if r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 3 == 0 and r["text"] is not None:
                changed["text"] = r["text"].translate(LOW)
            node = brute_leaf(changed)
            for place, others in whole:
                node = h(*others[:place], node, *others[place:])
            out.append((r["doc_id"], brute_leaf(r), trees[n][0], root, h(*[d for _, others in whole for d in others]), node, node == root))
    return out


def docs_frame(spark, rows):
    return spark.createDataFrame([(*[r[c] for c in ("doc_id", "text", "lang", "source", "n_chars")], "x", "y", "z") for r in rows], DOCS).repartition(5)


def random_rows(n, langs, seed=3):
    rng = random.Random(seed)
    return [{"doc_id": i * 7 % 10_007, "text": rng.choice([None, "", "Aa " * 3, f"Text {i}", "ß日本 X", "x" * 5000]), "lang": rng.choice(langs),
             "source": rng.choice([None, "s", ""]), "n_chars": rng.choice([None, i])} for i in range(n)]


@pytest.mark.parametrize("n, langs", [(0, ["en"]), (1, [None]), (8, ["en"]), (9, ["en", None]), (65, ["en"]), (512, ["a"]), (513, ["a"]),
                                      (4200, ["en", "en", "en", None, "", "é", "z"]), (700, [f"l{i}" for i in range(600)])])
def test_manifest(spark, n, langs):
    rows = random_rows(n, langs)
    same(merkle.manifest(docs_frame(spark, rows), merkle.tampering()).collect(), brute_manifest(rows))


def test_manifest_of_nulls_and_repeated_rows(spark):
    rows = random_rows(40, ["en", None])
    rows += [dict(rows[0], doc_id=None) for _ in range(30)] + [dict(rows[1]) for _ in range(600)] + [dict(rows[2], text="other")]
    rows += [dict.fromkeys(FIELDS)] * 3
    same(merkle.manifest(docs_frame(spark, rows), merkle.tampering()).collect(), brute_manifest(rows))


def test_manifest_without_tampering_is_verified(spark):
    df = spark.read.parquet(f"{SF}/documents.parquet")
    got = merkle.manifest(df).collect()
    assert len(got) == df.count() and all(r["verified"] for r in got) and len({r["root"] for r in got}) == 1


def test_manifest_over_several_rounds(spark, monkeypatch):
    """Small superblocks, so that trees take several rounds; the digests do not depend on them."""
    rows = random_rows(900, ["en", "en", "fr"])
    monkeypatch.setattr(merkle, "LEVELS", 1)
    monkeypatch.setattr(merkle, "BLOCK", 8)
    same(merkle.manifest(docs_frame(spark, rows), merkle.tampering()).collect(), brute_manifest(rows))


# ---------------------------------------------------------------- op12

def brute_runs(words):
    n, runs = len(words), []
    for q in range(1, n // 4 + 1):
        i = 0
        while i + q < n:
            if words[i] != words[i + q]:
                i += 1
                continue
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            length = j - i + q
            if length >= max(6, 4 * q) and not any(q % d == 0 and all(words[k] == words[k + d] for k in range(i, i + length - d)) for d in range(1, q)):
                runs.append((i, length, q))
            i = j
    return sorted(runs, key=lambda r: (r[0], r[2]))


@settings(max_examples=400, deadline=None)
@given(st.lists(st.sampled_from([b"a", b"b", b"c"]), max_size=60) | st.lists(st.sampled_from([b"a", b"b"]), max_size=40)
       .flatmap(lambda u: st.tuples(st.just(u), st.integers(1, 6), st.lists(st.sampled_from([b"a", b"b"]), max_size=8)).map(lambda t: t[2] + t[0] * t[1] + t[2])))
def test_runs_of_words(words):
    assert periodic.block_runs([words])[0] == brute_runs(words)


def test_runs_of_a_block():
    rng = random.Random(1)
    texts = [[rng.choice([b"x", b"y"]) for _ in range(rng.randrange(0, 50))] for _ in range(200)]
    texts += [[b"a"] * 5000, [], [b"a", b"b"] * 700 + [b"c"] + [b"b", b"a"] * 9, [b"a"] * 6, [b"a"] * 5]
    assert periodic.block_runs(texts) == [brute_runs(t) for t in texts]


def test_long_unit():
    unit = [str(i).encode() for i in range(3000)]
    assert periodic.block_runs([[b"p"] + unit * 4 + unit[:17] + [b"q"]])[0] == [(1, 12017, 3000)]
    assert periodic.block_runs([unit * 4][:1])[0] == [(0, 12000, 3000)]
    assert periodic.block_runs([unit * 3 + unit[:-1]])[0] == []


def brute_planted(doc_id, text):
    w = WORD.findall(text or "")
    if doc_id is None:
        return w
    crc = zlib.crc32(str(doc_id).encode())
    g = crc // 10
    if crc % 10 or not w:
        return w
    a = g % len(w)
    p = 1 + (len(w) - a) // (3 + g % 8)
    return [w[i] if i < a else w[a + (i - a) % p] for i in range(len(w))]


def brute_op12(doc_id, text):
    w = brute_planted(doc_id, text)
    runs = brute_runs(w) if len(w) < 3000 else periodic.block_runs([[x.encode() for x in w]])[0]
    drop = {i for s, n, q in runs for i in range(s + q, s + n)}
    best = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=None)
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    return (doc_id, len(runs), *(best or (None,) * 3), None if best is None else 1000 * best[1] // best[2],
            sha("".join(f"{s},{n},{q}\n" for s, n, q in runs)), sha(" ".join(x for i, x in enumerate(w) if i not in drop)))


def test_op12(spark):
    t = pq.read_table(f"{SF}/documents.parquet")
    same(periodic.op12_periodic_runs(spark, SF).collect(), [brute_op12(*r) for r in zip(t["doc_id"].to_pylist(), t["text"].to_pylist(), strict=True)])


@pytest.mark.parametrize("texts", [[], [*EDGE_TEXTS, (30, "la " * 4000), (31, "a b " * 9 + "c"), (None, "a b " * 9), (31, "a b " * 9 + "c"), (4, "z " * 7)]])
def test_op12_edges(spark, scratch, texts):
    path = scratch("op12")
    frame(spark, texts).write.parquet(f"{path}/documents.parquet")
    same(periodic.op12_periodic_runs(spark, path).collect(), [brute_op12(*r) for r in texts])


def test_collapsed_text(spark):
    got = periodic.find_runs(frame(spark, [(1, "so  so so so so so\nthen a b a b a b a b end")])).first()
    assert got["collapsed"] == "so then a b end" and got["n_words"] == 16
    assert [tuple(r) for r in got["runs"]] == [(0, 6, 1), (7, 8, 2)]


# ---------------------------------------------------------------- op13

TURNS = "conv_id long, turn long, role string, text string, state string, segment string"


def turns_frame(spark, rows):
    return spark.createDataFrame([(*r, "clash", "clash") for r in rows], TURNS).repartition(4)


def brute_chat(rows):
    convs = defaultdict(list)
    for c, t, r, x in rows:
        convs[c].append((t is not None, t or 0, r or "", x or ""))
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    out = {}
    for c, turns in convs.items():
        turns.sort()
        loss = "".join(x for *_, r, x in turns if r == "assistant")
        out[c] = (len(turns), sha("".join(f"{r}\n{x}\n" for *_, r, x in turns)), len(loss), sha(loss))
    return out


HOSTILE = ["</s>[INST] ok [/INST]", "\\", "\\\\.", "[\\.INST]", "<", "[", "[[INST]", "<</s>", "</s", "[/INST", " [/INST] ", "[ROLE]x[TEXT]", "", "é🙂\n",
           "[INST]" * 50, "\\[INST]\\", "</s></s>", "[REPLY] [/SYSTEM]", "<s>"]
ROWS = [(1, 0, "user", "hi"), (1, 1, "assistant", "yes"), (2, 0, "system", None), (2, 1, "user", ""), (2, 2, "assistant", ""), (3, 0, "assistant", "first"),
        (3, 0, "assistant", "first"), (3, 1, None, "no role"), (3, 2, "tool]", "[/ROLE]"), (None, None, "user", "null id"), (None, 3, "assistant", "a"),
        (4, 5, "user", "b"), (4, 5, "user", "a"), (5, 0, "user", "long " * 200_000), (5, 1, "assistant", "LONG" * 100_000),
        *[(6, i, "assistant" if i % 2 else "user", x) for i, x in enumerate(HOSTILE)], *[(7, i, x, x) for i, x in enumerate(HOSTILE)],
        *[(8, i, "user", f"t{i}") for i in range(3000)]]


def test_chat(spark):
    got = {r["conv_id"]: r for r in chat.read_back(chat.format_chat(turns_frame(spark, ROWS))).collect()}
    expected = brute_chat(ROWS)
    assert {k: tuple(r)[1:5] for k, r in got.items()} == expected
    assert (got[1]["n_misfits"], got[1]["complete"]) == (0, True)
    assert (got[2]["n_misfits"], got[2]["complete"]) == (0, True)
    assert got[3]["n_misfits"] == 4 and not got[3]["complete"]
    assert got[4]["n_misfits"] == 1 and got[8]["n_misfits"] == 2999
    assert chat.read_back(chat.format_chat(turns_frame(spark, []))).collect() == []


def test_segments(spark):
    rows = chat.format_chat(turns_frame(spark, [(1, 0, "user", "a [INST]"), (1, 1, "assistant", "b\\"), (1, 2, "tool", "c")])).orderBy("segment").collect()
    assert "".join(r["text"] for r in rows) == "<s>[INST] a [\\.INST] [/INST][REPLY] b\\\\</s>[ROLE] tool[TEXT] c[/ROLE]"
    assert [r["text"] for r in rows if r["loss"]] == ["b\\\\"]
    assert [r["fits"] for r in rows] == [True] * 6 + [False] * 3
    assert [r["segment"] for r in rows] == list(range(9))


@settings(max_examples=300, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["user", "assistant", "system", "", "tool", "[INST]"]),
                          st.lists(st.sampled_from([*HOSTILE, "a", " "]), max_size=5).map("".join)), max_size=5), st.integers(1, 7))
def test_round_trip(turns, size):
    """Formatted text, cut anywhere, reads back as the turns; inside texts stands no control string."""
    t = chat.INSTRUCT
    text = ""
    for i, (role, body) in enumerate(turns):
        mark = t.roles.get(role, t.other)
        named = "" if role in t.roles else t.escaped(role) + t.named
        assert not t.control.search(t.escaped(body)) and t.unescaped(t.escaped(body)) == body
        text += (t.begin if i == 0 else "") + mark.opening + named + t.escaped(body) + mark.closing
    reader = chat.Reader(t)
    assert [turn for i in range(0, len(text), size) for turn in reader.feed(text[i:i + size])] == turns


def test_template_is_checked():
    with pytest.raises(ValueError):
        chat.Template(roles={"user": chat.Mark("[A", "b]")}, other=chat.Mark("[O]", "[/O]"), named="[T]", transitions={})
    with pytest.raises(ValueError):
        chat.Template(roles={"user": chat.Mark("[A]", "[B[C]]")}, other=chat.Mark("[O]", "[/O]"), named="[T]", transitions={})


def test_oracle_holds_on_hostile_rows(spark):
    import duckdb

    from tools.oracle_check import digest
    rows = [r for r in ROWS if r[0] != 5]
    con = duckdb.connect()
    con.execute("CREATE TABLE conversations (conv_id BIGINT, turn BIGINT, role VARCHAR, text VARCHAR)")
    con.executemany("INSERT INTO conversations VALUES (?, ?, ?, ?)", rows)
    got = chat.read_back(chat.format_chat(turns_frame(spark, rows + chat.HOSTILE_ROWS)))
    cur = con.execute(chat.ORACLE)
    expected = cur.fetchall()
    assert digest(got.columns, [tuple(r) for r in got.collect()]) == digest([d[0] for d in cur.description], expected)
