"""Chat formatting, ranked search and conversation repair against plain versions, with every odd case."""

import hashlib
import math
import random
import re
import zlib

import pytest
from pyspark.sql import functions as F

from shelfline.llm import chat, ranked, repair

TALK = "conv_id bigint, turn bigint, role string, text string"


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


# --- 11: chat formatting ---

def plain_order(rows):
    return sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0, r[2] or "", r[3] or ""))


def test_chat_round_trip(spark):
    rng = random.Random(4)
    bits = ["<turn>", "</turn>\n", "<says>", "\\", "\\-", "\\(", "<", "<image 0>", "user", "\n", "é", "𝄞", " "]
    rows = [(c, t, rng.choice(["user", "assistant", "system", "a<b\\", None]),
             rng.choice([None, "", "".join(rng.choices(bits, k=rng.randrange(12)))]))
            for c in range(40) for t in range(rng.randrange(1, 9))]
    rows += [(50, t, "assistant" if t % 2 else "user", "x" * 500 + "\\<" * 300) for t in range(400)]   # one long conversation
    rows += [(51, None, "user", "b"), (51, None, "user", "a"), (51, 3, "assistant", "z"), (51, 3, "assistant", "z"),
             (None, 0, "assistant", "no id")]
    rng.shuffle(rows)
    table = spark.createDataFrame([(*r, "more", 1) for r in rows], TALK + ", formatted string, place int")
    made = chat.formatted(chat.with_probe(table)).cache()
    got = {r.conv_id: r for r in chat.read_back(made).collect()}
    rows += [(-7, 0, "user", "\\### Assistant: </turn> ok"), (-7, 1, "assistant", "\\### Assistant: </turn> ok")]
    figures = {r.conv_id: r for r in chat.report(made).collect()}
    texts = {r.conv_id: r.formatted for r in made.collect()}
    assert set(got) == {r[0] for r in rows} == set(figures)
    for conv in got:
        own = plain_order([r for r in rows if r[0] == conv])
        assert [(t.role, t.text) for t in got[conv].turns] == [(r[2] or "", r[3] or "") for r in own]
        loss = [r[3] or "" for r in own if r[2] == "assistant"]
        assert got[conv].loss_texts == loss
        f = figures[conv]
        assert (f.n_turns, f.turns_sha256) == (len(own), sha("".join(f"{r[2] or ''}\n{r[3] or ''}\n" for r in own)))
        assert (f.loss_chars, f.loss_sha256, f.formatted_chars) == (len("".join(loss)), sha("".join(loss)), len(texts[conv]))
        assert texts[conv].count("<turn>") == texts[conv].count("</turn>\n") == len(own)
    assert chat.report(chat.formatted(chat.with_probe(table.limit(0)))).count() == 1
    assert chat.read_back(chat.formatted(chat.with_probe(table).limit(0))).count() == 0


def test_typed_parts(spark):
    part = lambda **k: tuple(k.get(n) for n in ("kind", "text", "ref", "width", "height", "seconds", "pages"))
    rows = [
        (1, 1, "assistant", [part(kind="text", text="a <image 0> b"), part(kind="document", ref="d", pages=2),
                             part(kind="text", text=None)]),
        (1, 0, "user", [part(kind="text", text="see <tu"), part(kind="text", text="rn>"), part(kind="image", ref="s3", width=57, height=28),
                        part(kind="audio", ref="w", seconds=1.5), None]),
        (1, 2, "assistant", None), (1, 3, "user", []), (1, 4, "user", [part(kind="video", ref="v"), part(kind="image", ref="x"),
                                                                       part(text="kindless")]),
    ]
    got = chat.formatted(spark.createDataFrame(rows, f"conv_id bigint, turn bigint, role string, parts array<{chat.PART}>")).first()
    assert got.formatted == ("<turn>user<says>see \\(turn><image 0><audio 1></turn>\n"
                             "<turn>assistant<says>a \\(image 0> b<document 2></turn>\n"
                             "<turn>assistant<says></turn>\n<turn>user<says></turn>\n<turn>user<says><other 3><image 4>kindless</turn>\n")
    assert [tuple(a) for a in got.attachments] == [
        (0, "image", "s3", 3), (1, "audio", "w", 38), (2, "document", "d", 1024), (3, "other", "v", 0), (4, "image", "x", 0)]
    assert [s and got.formatted[s.first:s.last] for s in got.loss] == [None, "a \\(image 0> b<document 2>", "", None, None]
    assert got.n_tokens == 2 + 1 + 3 + 38 + 4 + 1024 + 2


def test_formatting_stays_native(spark):
    plan = chat.report(chat.formatted(chat.with_probe(spark.createDataFrame([(1, 0, "user", "x")], TALK))))
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in text and "Arrow" not in text and text.count("Exchange hashpartitioning") == 1


# --- 12: ranked search ---

TERM = re.compile("[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms(text):
    return ["".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in w) for w in TERM.findall(text or "")]


def plain_ranking(docs, items, k=20):
    """Rows by position of the item, every document scored."""
    held = [(i, terms(t)) for i, t in docs]
    held = [(i, w) for i, w in held if w]
    n_docs, total = len(held), sum(len(w) for _, w in held)
    out = []
    for item, text in items:
        rows = []
        for doc, own in held:
            m = 100 - 25 + (25 * len(own) * n_docs) // total
            score = 0
            for t in terms(text):
                tf = own.count(t)
                if tf:
                    w = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * sum(t in o for _, o in held) + 1)))
                    score += w * ((1000000000 * tf) // (1000 * tf + 12 * m))
            if score > 0:
                rows.append((-score, doc is None, doc or 0))
        out += [(item, r + 1, None if nameless else doc, -s) for r, (s, nameless, doc) in enumerate(sorted(rows)[:k])]
    return out


def key(rows):
    return sorted(rows, key=lambda r: tuple((x is not None, x or 0) for x in r))


@pytest.mark.parametrize("block, at_once, seed", [(4, 1 << 16, 16), (2, 130, 1)])
def test_ranked(spark, block, at_once, seed):
    rng = random.Random(block)
    words = [f"w{i}" for i in range(60)] + ["Émile", "ÉMILE", "a_b", "日本"]
    text = lambda n: " ".join(words[min(int(rng.expovariate(0.12)), 63)] for _ in range(n))
    docs = [(i, text(rng.randrange(1, 60))) for i in range(300)]
    docs += [(400 + i, docs[7][1]) for i in range(40)]                   # many equal scores
    docs += [(None, docs[3][1]), (5, docs[3][1]), (5, docs[3][1]), (500, None), (501, ""), (502, "!? .."),
             (503, text(30_000)), (504, "W1.w1-W1")]
    items = [(i, text(rng.randrange(1, 40))) for i in range(12)]
    items += [(20, None), (21, ""), (22, "unseen words only"), (23, docs[7][1]), (23, "w1"), (None, "w2 w2 w2"), (24, "w3 " * 500)]
    rng.shuffle(docs)
    frame = spark.createDataFrame([(*d, 1, "c") for d in docs], "doc_id bigint, text string, score int, shard string").repartition(3)
    asked = spark.createDataFrame([(*i, 2) for i in items], "item_id bigint, text string, query int")
    got = ranked.ranked(frame, asked, block=block, terms_at_once=at_once, seed=seed).collect()
    assert key(tuple(r) for r in got) == key(plain_ranking(docs, items))
    if seed == 1:
        for empty in ((frame.limit(0), asked), (frame, asked.limit(0)), (frame.where("doc_id > 499 and doc_id < 503"), asked)):
            assert ranked.ranked(*empty).collect() == []


def test_blocks_are_skipped_and_bounds_hold(spark):
    """Summaries are the largest impacts of their documents, and a bound that nothing reaches opens no block."""
    import numpy as np
    rng = np.random.default_rng(1)
    width, n = 40, 200
    table = np.where(rng.random((n, width)) < np.linspace(0.05, 0.4, width), rng.integers(1, 10 ** 6, (n, width)), 0)
    row, column = np.nonzero(table)
    bounds = np.searchsorted(row, np.arange(n + 1))
    weights = np.sort(rng.integers(1, 9000, width))[::-1]
    made = ranked.Shard(column, table[row, column], bounds, width).lists(weights, 8)
    at_doc, at_column, block = 0, 0, 0
    for term, blocks in zip(made["terms"], made["list_blocks"]):
        seen = []
        for _ in range(blocks):
            docs = made["docs"][at_doc:at_doc + made["block_docs"][block]]
            inside = slice(at_column, at_column + made["block_columns"][block])
            summary = np.zeros(width)
            summary[made["summary_columns"][inside]] = made["summary"][inside]
            if inside.start == inside.stop:
                assert len(docs) == 1 and (table[:, term] > 0).sum() < ranked.FEW
                summary = table[docs[0]]
            assert (summary[term:] == table[docs, term:].max(axis=0)).all() and len(docs) <= 8
            at_doc, at_column, block, seen = at_doc + len(docs), inside.stop, block + 1, [*seen, *docs]
        assert sorted(seen) == np.flatnonzero(table[:, term]).tolist()
    asked = (rng.random((3, width)) < 0.3) * weights.astype(float)
    ids = {"ids": np.arange(n), "bounds": bounds, "columns": column, "impacts": table[row, column], **made}
    opened = lambda least: ranked._scored(ids, np.zeros(n, bool), asked, ranked.Best(np.full(3, least), 5))
    best = np.sort(table @ asked[0].astype(np.int64))[-5]
    assert opened(10 ** 15) == 0 and 0 < opened(int(best)) < opened(0)


# --- 13: conversation repair ---

def plain_repair(rows):
    """All figures of one conversation, by a table of (cost, edits, lines) for every state."""
    rows = sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0, r[2], r[3]))
    white = " \t\n\x0b\f\r"
    seen, faults = set(), []
    for _, _, role, text in rows:
        bare = text.strip(white)
        faults.append("blank" if not bare else "duplicate" if (role, text) in seen else "truncated" if bare[-1] not in ".!?" else "")
        seen.add((role, text))
    after = {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("a", "u"): "u", ("u", "a"): "a"}
    names = {"u": "user", "a": "assistant"}

    def grow(states):
        for _ in range(3):
            for state, (cost, edits, lines) in list(states.items()):
                for initial, name in names.items():
                    if (state, initial) in after:
                        new = cost + 2, edits + "I", (*lines, name + ":")
                        states[after[state, initial]] = min(states.get(after[state, initial], new), new)
        return states
    states = grow({"": (0, "", ())})
    for (_, _, role, text), fault in zip(rows, faults):
        to = {}
        for state, (cost, edits, lines) in states.items():
            ways = [(state, cost + 3, "D", lines)]
            if fault not in ("blank", "duplicate"):
                extra = cost + (fault == "truncated")
                ways += [(after[state, role[:1]], extra, "K", (*lines, f"{role}:{text}"))] if (state, role[:1]) in after else []
                ways += [(after[state, i], extra + 2, "R", (*lines, f"{n}:{text}")) for i, n in names.items() if (state, i) in after]
            for where, c, e, out in ways:
                new = c, edits + e, out
                to[where] = min(to.get(where, new), new)
        states = grow(to)
    cost, audit, lines = min(states[s] for s in ("", "a") if s in states)
    turns = [r[1] for r in rows if r[1] is not None]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    illegal = sum(a[2][:1] + b[2][:1] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:]))
    return (gaps, *(faults.count(f) for f in ("blank", "duplicate", "truncated")), illegal, cost, audit, sha("\n".join(lines))), lines


def plain_damage(rows):
    out = []
    for conv, turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        what = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        if what:
            row = (conv, turn, "user" if what == 4 else role,
                   "" if what == 1 else re.sub("[.!?]", "", text) if what == 2 else text)
            out += [row] * (2 if what == 3 else 1)
    return out


def random_talk(seed, convs, longest):
    rng = random.Random(seed)
    rows = []
    for conv in range(convs):
        for turn in range(rng.randrange(1, longest)):
            rows.append((conv, rng.choice([turn, turn, turn, 2 * turn, None]), rng.choice(["user", "assistant", "user", "assistant", "system", "tool", "", None]),
                         rng.choice([f"t{rng.randrange(9)}.", f"t{rng.randrange(9)}! \n", "cut off", "", " \t", None, f"é{turn}?"])))
    rows += [(None, 0, "user", "Hi."), (None, 1, "assistant", "Yes."), (900, None, "user", "Hi."), (901, 7, "system", "Only.")]
    return rows


def test_repair(spark):
    rows = random_talk(1, 300, 14)
    frame = spark.createDataFrame([(*r, "x", True) for r in rows], TALK + ", gone string, kind boolean").repartition(5)
    got = {r.conv_id: tuple(r)[1:] for r in repair.audits(repair.damaged(frame), gone="gone").collect()}
    left = plain_damage(rows)
    assert set(got) == {r[0] for r in rows}
    for conv in got:
        assert got[conv] == plain_repair([r for r in left if r[0] == conv])[0], conv
    assert any(v[-2] == "" and v[5] == 0 for v in got.values()) and any("I" in v[-2] for v in got.values())
    undamaged = {r.conv_id: tuple(r)[1:] for r in repair.audits(frame).collect()}
    lines = {}
    for r in repair.repaired(frame).orderBy("conv_id", "place").collect():
        lines.setdefault(r.conv_id, []).append(f"{r.role}:{r.text}")
    for conv in undamaged:
        own = [tuple(" " if x is None and i > 1 else x for i, x in enumerate(r)) for r in rows if r[0] == conv]
        figures, out = plain_repair(own)
        assert undamaged[conv] == figures and tuple(lines.get(conv, ())) == out
    assert repair.audits(repair.damaged(frame.limit(0)), gone="gone").count() == repair.repaired(frame.limit(0)).count() == 0


def test_long_conversations_settle(spark, monkeypatch):
    """Edits handed out in parts are those of the whole search."""
    monkeypatch.setattr(repair, "SETTLE", 16)
    rng = random.Random(3)
    for case in range(40):
        kinds = "".join(rng.choices("uuaaUAsbdo" if case % 2 else "uaua" * 6 + "bUo", k=400))
        talk, out, most = repair.Conversation(1), [], 0
        for i, kind in enumerate(kinds):
            out += talk.add(i, kind.lower() if kind in "uaUAs" else "x", kind, {"u": b"user", "a": b"assistant", "s": b"system"}.get(
                kind.lower(), b"tool"), b"%d" % i)
            most = max(most, len(talk.waiting))
        out += talk.finish()
        states = {"": (0, "")}
        assert "".join(talk.audit) == repair.cheapest.__wrapped__(kinds)[1] and talk.cost == repair.cheapest.__wrapped__(kinds)[0]
        assert re.fullmatch("(s?(ua)+)?", "".join(role[:1].decode() for _, role, _ in out)) and most < 200 and states


def test_paths_compare_like_strings(monkeypatch):
    """Also where the hashes of different paths collide."""
    for modulus in (repair.MODULUS, 2, 3):
        monkeypatch.setattr(repair, "MODULUS", modulus)
        rng, root = random.Random(modulus), repair.Node(None, "")
        nodes = [(root, "")]
        for _ in range(150):
            parent, text = rng.choice(nodes[-20:])
            edit = rng.choice("DIKR")
            nodes.append((repair.Node(parent, edit), text + edit))
        for _ in range(1500):
            (a, x), (b, y) = rng.choice(nodes), rng.choice(nodes)
            assert repair.less(a, b) == (x < y) and repair.edits(a) == x


def test_huge_gaps_do_not_crash(spark):
    rows = [(1, -(1 << 63), "user", "a."), (1, (1 << 63) - 1, "assistant", "b.")]
    assert repair.audits(spark.createDataFrame(rows, TALK)).first().gaps == (1 << 63) - 1
    assert repair.damaged(spark.createDataFrame([], TALK)).agg(F.count("*")).first()[0] == 0
