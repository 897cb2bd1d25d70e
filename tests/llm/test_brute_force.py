"""Operators that SQL cannot express, against plain Python that follows their definitions."""

import hashlib
import json
import re
import string

import numpy as np
import pytest
from pyspark.sql import functions as F

from synonymy.llm import chat, decontaminate, licenses, pii, secrets, toxicity

SF = "/root/testdata/sf0.001"
LOWER = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")


def table(spark, texts, first=1):
    return spark.createDataFrame([(i, t) for i, t in enumerate(texts, first)], "doc_id long, text string")


# ---------------------------------------------------------------- licences
def license_base(text):
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))
    places, labels = [], set()
    for phrase, label in (("cc by", "cc-by"), ("general public license", "gpl"), ("all rights reserved", "reserved")):
        p = phrase.split()
        at = [i for i in range(len(words) - len(p) + 1) if words[i : i + len(p)] == p]
        places += at
        labels |= {label} if at else set()
    return len(words), len(places), min(places, default=None), max(places, default=None), ",".join(sorted(labels))


def test_license_base_columns(spark, docs):
    want = {r.doc_id: license_base(r.text) for r in docs.collect()}
    got = {r.doc_id: (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) for r in licenses.scan(docs).collect()}
    assert got == want and any(w[1] for w in want.values())


LICENSED = [
    "mit license", "mit license", "x " * 20 + "mit license", "released under the mit license", "the software is provided as is without warranty of any kind", "Licensed under the Apache License", "", None,
    "permission granted free of charge mit", "This program is free software; you can redistribute it under the terms of the GNU General Public License", "the of any and the", "released under the MIT licence mit license",
]


def test_license_labels_do_not_depend_on_neighbours(spark):
    alone = {}
    for i, t in enumerate(LICENSED):
        r = licenses.scan(table(spark, [t], i).coalesce(1)).first()
        alone[i] = (r.labels, r.score)
    rows = list(enumerate(LICENSED))
    for order, parts in ((rows, 1), (rows[::-1], 1), (rows[5:] + rows[:5], 1), (rows, 3)):
        d = spark.createDataFrame(order, "doc_id long, text string").repartition(parts) if parts > 1 else spark.createDataFrame(order, "doc_id long, text string").coalesce(1)
        got = {r.doc_id: set(r.labels.split(",")) - {""} for r in licenses.scan(d).collect()}
        assert got[0] == got[1] and "mit" in got[3] and not got[10]
        assert got == {i: set(a.split(",")) - {""} for i, (a, _) in alone.items()}


# ---------------------------------------------------------------- personal data
def luhn(d):
    return sum(int(c) if i % 2 == 0 else sum(map(int, str(2 * int(c)))) for i, c in enumerate(reversed(d))) % 10 == 0


def pii_base(text):
    text, out = text or "", []
    for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text):
        out.append((m.start(), 0, "email", m.end()))
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all(int(p) <= 255 for p in m[0].split(".")):
            out.append((m.start(), 1, "ip", m.end()))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        d = re.sub("[^0-9]", "", m[0])
        if 14 <= len(d) <= 19 and luhn(d):
            out.append((m.start(), 2, "card", m.end()))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 10 <= len(re.sub("[^0-9]", "", m[0])) <= 15:
            out.append((m.start(), 3, "phone", m.end()))
    return sorted(out)


def digest(spans):
    return hashlib.sha256(",".join(f"{k}:{a}:{b}" for a, _, k, b in spans).encode()).hexdigest()


def test_pii_base_spans(spark, docs):
    rng = np.random.default_rng(4)
    bits = ["a@b.co", "x.y@z", "@", ".", "10.0.0.1", "1.2.3.4.5", "4111 1111 1111 1111", "4111111111111112", "+1 (555) 010-9999", "+1 2", " ", "é", "😀", "-", "7", "42 42", "+4915112345678"]
    fuzz = ["".join(rng.choice(bits, rng.integers(1, 14))) for _ in range(400)] + [" ".join(f"u{i}@h.example.org 10.1.{i % 256}.9" for i in range(500)), "a@b.co" * 200, None, ""]
    every = table(spark, fuzz, 10**6).union(docs)
    want = {r.doc_id: pii_base(r.text) for r in every.collect()}
    for r in pii.find(every).collect():
        base = want[r.doc_id]
        assert r.base_sha256 == digest(base), r
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(x[1] == k for x in base) for k in range(4)]
        assert {f"{k}:{a}:{b}" for a, _, k, b in base} <= set(r.spans.split(","))


def test_pii_adds_spelled_out_data(spark):
    """Planted forms that no base rule covers, among numbers that only look alike."""
    rng = np.random.default_rng(5)
    plain = [f"contact us by mail: user{i}@host{i}.example.com or call +1 (555) 010-{1000 + i}" for i in range(150)]
    hidden = [f"please write to name{i} [at] mail{i} [dot] com today" for i in range(40)] + [f"call us, tel (555) 210-{4000 + i} now" for i in range(40)]
    alike = [f"order {i} was built as release {rng.integers(100)} of section {rng.integers(100)}, meet [at] noon" for i in range(100)]
    got = {r.doc_id: r.n_added for r in pii.find(table(spark, plain + hidden + alike, 0)).collect()}
    caught = sum(got[150 + i] > 0 for i in range(80)) / 80
    false = sum(got[230 + i] > 0 for i in range(100)) + sum(got[i] > 0 for i in range(150))
    assert caught >= 0.9 and false <= 5, (caught, false)


# ---------------------------------------------------------------- secrets
def secret_base(text):
    text, out = text or "", []
    for m in re.finditer(r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", text):
        if len(m[2]) >= 6:
            out.append((m.start(), 0, "assign", m.end()))
    out += [(m.start(), 1, "access", m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    out += [(m.start(), 2, "hex", m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]
    return sorted(out)


def test_secret_base_spans(spark, docs):
    rng = np.random.default_rng(6)
    bits = ["password", "PassWD", "api_key", "APIKEY", "\u017fecret", "to\u212aen", "tokeN", ":", " = ", '"', "'", "abc123", "AKIA", "ABCDEFGH12345678", "deadbeef", "0123456789abcdef01234567", " ", "é", "=", "-"]
    fuzz = ["".join(rng.choice(bits, rng.integers(1, 12))) for _ in range(600)] + [None, ""]
    every = table(spark, fuzz, 10**6).union(docs)
    want = {r.doc_id: secret_base(r.text and r.text.replace("\u212a", "~").replace("\u017f", "~")) for r in every.collect()}
    for r in secrets.scan(every).collect():
        base = want[r.doc_id]
        assert r.base_sha256 == digest(base), r
        assert [r.n_assign, r.n_access, r.n_hex] == [sum(x[1] == k for x in base) for k in range(3)]


def test_secret_models_tell_keys_from_identifiers(spark):
    rng = np.random.default_rng(7)
    words = "account balance customer record value index response handler request stream window buffer encoder reader writer".split()
    names = ["_".join(rng.choice(words, 5)) for _ in range(300)] + ["".join(w.title() for w in rng.choice(words, 5)) for _ in range(300)]
    keys = ["".join(rng.choice(list(string.ascii_letters + string.digits), 32)) for _ in range(100)]
    d = table(spark, [f"use {x} here" for x in names] + [f"use {x} here" for x in keys], 0)
    got = {r.doc_id for r in secrets.scan(d).where("spans like '%markov%'").collect()}
    caught, false = len([i for i in got if i >= 600]), len([i for i in got if i < 600])
    assert caught >= 80 and false <= 6, (caught, false)


# ---------------------------------------------------------------- toxicity
def test_toxicity_lexicon_score(spark):
    """Scores of a given lexicon, word by word: a word counts its heaviest entry unless it is an exception."""
    lexicon = toxicity.Lexicon({" scum": 3.0, " idiot ": 2.0, " idi": 1.0}, ["scumble"], (-2.0, 1.0, 1.0))
    rng = np.random.default_rng(8)
    bits = ["scum", "scumbag", "scumble", "idiot", "idiotic", "1d10t", "ѕcum", "SCUM!", "s​cum", "nice", "idiom", "x" * 70 + "1", "sc" + "u" * 80, "2024"]
    for _ in range(200):
        words = list(rng.choice(bits, rng.integers(0, 9)))
        total = 0.0
        for w in words:
            f = toxicity.fold_word(w.lower())
            if f and f != "scumble":
                total += max([v for e, v in lexicon.weights.items() if f" {f} ".startswith(e)], default=0.0)
        got, n = lexicon.sums(" ".join(words))
        assert (round(got, 9), n) == (round(total, 9), len(words))


def test_toxicity_folds_long_words():
    long = "1d1оt" * 20
    assert toxicity.folded(long) == ["idiot" * 20]


def test_toxicity_takes_all_entries(spark):
    """More marked words than any cap; each of them decides on a held-out text."""
    marks = [f"{chr(97 + i // 676 % 26)}{chr(97 + i // 26 % 26)}{chr(97 + i % 26)}q{chr(97 + i % 7)}w" for i in range(1500)]
    rows = [(i, f"some text {i} " + " ".join(marks[k] for k in range(i % 40, 1500, 40))) for i in range(240)]
    clean = [(10**5 + i, f"some text and more {i} words here") for i in range(6000)]
    d = spark.createDataFrame(rows + clean, "doc_id long, text string")
    y = spark.createDataFrame([(i, int(i < 10**5)) for i, _ in rows + clean], "doc_id long, toxic int")
    lexicon = toxicity.learn(d, y)
    assert sum(lexicon.sums(m)[0] > 0 for m in marks) > 1000


# ---------------------------------------------------------------- decontamination
def smith_waterman(a, b):
    h = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    best = 0
    for i in range(1, len(a) + 1):
        for j in range(1, len(b) + 1):
            h[i][j] = max(0, h[i - 1][j - 1] + (2 if a[i - 1] == b[j - 1] else -1), h[i - 1][j] - 1, h[i][j - 1] - 1)
            best = max(best, h[i][j])
    return best


def test_alignments_agree():
    rng = np.random.default_rng(9)
    for _ in range(200):
        a, b = rng.integers(0, 6, rng.integers(1, 25)), rng.integers(0, 6, rng.integers(1, 60))
        want = decontaminate.align(a, b)
        assert decontaminate.align(a, b, cells=0) == want and want[0] == smith_waterman(list(a), list(b))
    a, b = rng.integers(0, 5000, 3000), rng.integers(0, 5000, 6000)
    b[1000:4000] = a
    score, matches, item_start, begin, end = decontaminate.align(a, b)
    assert score == 6000 and matches == 3000 and (item_start, begin, end) == (0, 1000, 4000)


def good(item, words):
    """Whether the pair's best alignment is good enough; its score is held against plain Python above."""
    number = {w: i for i, w in enumerate(sorted({*item, *words}))}
    score, matches, *_ = decontaminate.align(np.array([number[w] for w in item]), np.array([number[w] for w in words]))
    return score == smith_waterman(item, words) and score / (2 * len(item)) >= decontaminate.LEAST_SCORE and matches >= decontaminate.LEAST_MATCHES


def test_decontamination_against_all_alignments(spark):
    rng = np.random.default_rng(10)
    vocabulary = [f"v{i}" for i in range(400)]
    items = [list(rng.choice(vocabulary, rng.integers(15, 50))) for _ in range(12)]
    rows = []
    for i in range(80):
        body = list(rng.choice(vocabulary, 60))
        if i % 2:
            item = list(items[i % 12])
            for at in range(6, len(item), 7):
                item[at] = "changed"
            body[20:20] = item[: len(item) if i % 3 else len(item) // 2]
        rows.append((i, " ".join(body)))
    got = {(r.doc_id, r.item_id) for r in decontaminate.contaminated(spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame([(i, " ".join(x)) for i, x in enumerate(items)], "item_id long, text string")).collect()}
    want = {(i, k) for i, t in rows for k, item in enumerate(items) if good(item, t.split())}
    assert {p for p in want if p[0] % 2} <= got and got <= want


def test_decontamination_of_a_common_passage(spark):
    """An item of which every document holds an edited copy keeps seeds from start to end."""
    item = [f"w{i}" for i in range(64)]
    rows = [(i, " ".join(item if i % 2 else item[:20]) + f" own{i} " * 3) for i in range(400)] + [(400, " ".join(item[40:]) + " tail " * 20)]
    got = {r.doc_id for r in decontaminate.contaminated(spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame([(1, " ".join(item))], "item_id long, text string"), least=0.3).collect()}
    assert got == set(range(401))


# ---------------------------------------------------------------- chat
def conversation(conv, depth, rng):
    """Calls in a chain of that depth, some refs broken or cyclic, messages in random turns."""
    rows = [(conv, "user", "hello", None, ())]
    for k in range(depth):
        refs = [f"c{k - 1}"] if k and rng.random() < 0.8 else []
        if rng.random() < 0.1:
            refs.append(f"c{k + 1}")
        arguments = {"url": {"$ref": refs[0]} if refs else "u"} | ({"timeout": {"$ref": refs[1]}} if len(refs) > 1 else {})
        rows.append((conv, "assistant", json.dumps({"tool_calls": [{"id": f"c{k}", "name": "fetch", "arguments": arguments}]}), f"c{k}", tuple(refs)))
        if rng.random() < 0.9:
            rows.append((conv, "tool", json.dumps({"tool_call_id": f"c{k}", "content": k}), f"c{k}", ()))
    order = rng.permutation(len(rows))
    return [(conv, int(t), *r[1:]) for r, t in zip(rows, order, strict=True)]


def placed(rows):
    """turn -> (seq, status) by the definition."""
    call = {r[4]: r[1] for r in rows if r[2] == "assistant"}
    result = {r[4]: r[1] for r in rows if r[2] == "tool" and r[4] in call}
    behind = {r[1]: set() for r in rows}
    for r in rows:
        if r[2] == "tool" and r[4] in call:
            behind[r[1]].add(call[r[4]])
        behind[r[1]] |= {result[x] for x in r[5] if x in result}
    known, changed = {}, True
    while changed:
        changed = False
        for t, b in behind.items():
            if t not in known and all(x in known for x in b):
                known[t] = (max([known[x][0] for x in b] + [t]), max([known[x][1] + 1 for x in b], default=0))
                changed = True
    turns = sorted(behind, key=lambda t: (*known.get(t, (t, 0)), t))
    out = {}
    for r in rows:
        linked = r[4] in result
        out[r[1]] = (turns.index(r[1]), "plain" if r[2] == "user" else "cycle" if r[1] not in known else "linked" if linked else "unlinked")
    return out


@pytest.mark.parametrize("task_edges", [chat.TASK_EDGES, 6])
def test_chat_against_definition(spark, task_edges):
    rng = np.random.default_rng(11)
    every = [conversation(c, d, rng) for c, d in enumerate((0, 1, 2, 3, 5, 8, 50 if task_edges > 6 else 6))]
    d = spark.createDataFrame([r[:4] for rows in every for r in rows], "conv_id long, turn long, role string, text string").repartition(5)
    got = {(r.conv_id, r.turn): (r.seq, r.status) for r in chat.link(d, task_edges=task_edges).collect()}
    assert got == {(c, t): x for c, rows in enumerate(every) for t, x in placed(rows).items()}


def test_chat_takes_odd_calls(spark):
    call = lambda name, arguments, i="c1": json.dumps({"tool_calls": [{"id": i, "name": name, "arguments": arguments}]})
    texts = [
        call({"a": 1}, {}), call(["x"], {}), call(None, {}), call("search", {"query": "\ud800 lone"}), '{"tool_calls": [{"id": "c9", "name": "search", "arguments": {"query": "\\ud83d"}}]}', '{"tool_calls": {"id": "x"}}',
        '{"tool_calls": [1, "x", null]}', "{'tool_calls': [{'id': 'q'}]}", '{"tool_calls": [' + "[" * 3000 + "]" * 3000 + "]}", call("search", {"query": 1}), call("search", '{"query": "q"}'), '{"tool_calls": [{"id": "n", "name": "search", "arguments": {"query": "q", "limit": 1e999}}]}', "{}", "", None,
    ]
    d = spark.createDataFrame([(1, i, "assistant", t) for i, t in enumerate(texts)] + [(1, None, "tool", "x")] * 3 + [(None, None, None, None)] * 2, "conv_id long, turn long, role string, text string").select("*", F.lit(1).alias("seq"), F.lit(2).alias("JSON"))
    got = chat.link(d).collect()
    assert len(got) == len(texts) + 5
    assert sorted(r.seq for r in got if r.conv_id == 1) == list(range(len(texts) + 3))
    by_turn = {r.turn: r for r in got if r.turn is not None}
    assert not by_turn[0].valid and not by_turn[1].valid and not by_turn[2].valid and not by_turn[9].valid and by_turn[10].valid
    assert by_turn[4].valid and "\\ud83d" in by_turn[4].json
    for r in got:
        json.loads(r.json)


def test_chat_numbers_a_hot_conversation(spark):
    """One conversation over all ranges of the sort, with one turn that many messages share."""
    d = spark.range(5000).selectExpr("CASE WHEN id < 4500 THEN 7 ELSE id % 10 END AS conv_id", "CASE WHEN id % 3 = 0 THEN 5 ELSE id END AS turn", "'user' AS role", "'t' || id AS text")
    got = chat.link(d).toPandas()
    for _, g in got.groupby("conv_id"):
        g = g.sort_values("seq")
        assert list(g.seq) == list(range(len(g))) and g.turn.is_monotonic_increasing


# ---------------------------------------------------------------- packing, neighbours, odd tables
def test_packing_of_odd_strings(spark):
    import public_tokenizers
    from tokenizers import Tokenizer

    from synonymy.llm import packing

    odd = ["<|endoftext|>", "a<|endoftext|>b", "  x　y", "é́̀", "👩‍👩‍👧 ‍", "\x00\x01\x7f", "\r\n\r\n  \t x", "ﬁ ℌ Ⅷ", "'s 'S 'll I'LL", "1234567890 12 3", " " * 50, "مرحبا שלום", "x" * 5000, "the" * 700, None, ""]
    t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    got = {}
    for r in sorted(packing.pack(table(spark, odd, 0)).collect(), key=lambda r: (r.doc_id, r.start)):
        got.setdefault(r.doc_id, []).extend(np.frombuffer(bytes(r.ids), "<u4").tolist())
    assert got == {i: [*t.encode(x or "", add_special_tokens=False).ids, 0] for i, x in enumerate(odd)}


def test_nearest_of_odd_tables(spark):
    from synonymy.llm import ann

    rng = np.random.default_rng(13)
    x = rng.normal(size=(300, 8))
    rows = [(i, [float(c) for c in v]) for i, v in enumerate(x)] + [(5, [9.0] * 8), (None, [1.0] * 8), (400, [1.0, None] * 4), (401, [float("inf")] * 8), (402, []), (403, None), (404, [1.0, 2.0, 3.0]), (405, [3.0, 2.0, 1.0])]
    d = spark.createDataFrame(rows, "vec_id long, embedding array<double>").select("*", F.lit("x").alias("VEC_ID"), F.lit(1).alias("shard"), F.lit(2).alias("rank"))
    got = ann.nearest(d, d.where("embedding is not null").where(F.col("shard") == 1).where("`rank` = 2"), 20, shard_rows=64).toPandas()
    assert set(got[got.query_id == 404].vec_id) == {405} and 400 not in set(got.query_id) and 401 not in set(got.vec_id)
    best = x.copy()
    best[5] = min(tuple(x[5]), (9.0,) * 8)
    hits = 0
    for q in range(300):
        s = best @ best[q]
        o = [i for i in np.lexsort((np.arange(300), -s)) if i != q][:20]
        mine = got[got.query_id == q].sort_values("rank")
        hits += len(set(o) & set(mine.vec_id))
        assert list(mine["rank"]) == list(range(1, 21)) and np.allclose(mine.score, s[mine.vec_id]) and (np.diff(mine.score) <= 0).all()
    assert hits / 6000 >= 0.95


def test_toxicity_without_labels(spark):
    d = table(spark, ["a", None, "b c"], 0)
    none = spark.createDataFrame([], "doc_id long, toxic int")
    assert [r.predicted for r in toxicity.score(d, none).collect()] == [0, 0, 0]
    assert toxicity.tolerated(d, none).count() == 3


def test_pii_of_many_spans(spark):
    """A long text of thousands of addresses costs about what its length costs."""
    import time

    text = " ".join(f"u{i}@h.example.org" for i in range(8000))
    d = table(spark, [text], 0)
    began = time.time()
    r = pii.find(d).first()
    assert r.n_email == 8000 and r.base_sha256 == digest(pii_base(text)) and time.time() - began < 60


def test_chat_takes_text_for_json_once(spark):
    """A text that goes on after its object is plain content to all steps."""
    call = json.dumps({"tool_calls": [{"id": "a", "name": "fetch", "arguments": {"url": "u"}}]})
    result = json.dumps({"tool_call_id": "a", "content": 1})
    d = spark.createDataFrame([(1, 0, "assistant", call + " trailing"), (1, 1, "tool", result), (2, 0, "assistant", call), (2, 1, "tool", result + "}"), (3, 0, "assistant", "  " + call + "\n"), (3, 1, "tool", result)], "conv_id long, turn long, role string, text string")
    got = {(r.conv_id, r.turn): (r.n_calls, r.n_linked, r.status) for r in chat.link(d).collect()}
    assert got == {(1, 0): (0, 0, "plain"), (1, 1): (0, 0, "unlinked"), (2, 0): (1, 0, "unlinked"), (2, 1): (0, 0, "plain"), (3, 0): (1, 1, "linked"), (3, 1): (0, 1, "linked")}
    assert json.loads(chat.link(d).where("conv_id = 1 and turn = 0").first().json)["content"] == call + " trailing"


@pytest.mark.parametrize("task_edges", [chat.TASK_EDGES, 1])
def test_chat_orders_calls_of_one_message(spark, task_edges):
    """y waits for z's result; p and q wait for each other; an id may be a number."""
    fetch = lambda i, ref=None: {"id": i, "name": "fetch", "arguments": {"url": {"$ref": ref} if ref else "u"}}
    rows = [
        (1, 0, "assistant", json.dumps({"tool_calls": [fetch("y", "z"), fetch("z")]})), (1, 1, "tool", json.dumps({"tool_call_id": "y"})), (1, 2, "tool", json.dumps({"tool_call_id": "z"})),
        (2, 0, "assistant", json.dumps({"tool_calls": [fetch("p", "q"), fetch("q", "p"), fetch("r")]})), (2, 1, "tool", json.dumps({"tool_call_id": "p"})), (2, 2, "tool", json.dumps({"tool_call_id": "q"})), (2, 3, "tool", json.dumps({"tool_call_id": "r"})),
        (3, 5, "assistant", json.dumps({"tool_calls": [fetch(7)]})), (3, 1, "tool", json.dumps({"tool_call_id": 7})),
    ]
    d = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    got = {(r.conv_id, r.turn): (r.seq, r.n_calls, r.n_linked, r.status) for r in chat.link(d, task_edges=task_edges).collect()}
    assert got[1, 0] == (0, 2, 2, "linked") and got[1, 2] == (1, 0, 1, "linked") and got[1, 1] == (2, 0, 1, "linked")
    assert [got[2, t][3] for t in range(4)] == ["cycle", "cycle", "cycle", "linked"]
    assert got[3, 5] == (0, 1, 1, "linked") and got[3, 1] == (1, 0, 1, "linked")


def test_chat_links_a_planted_table(spark):
    """30,000 calls in chains of three, a third of them in one conversation."""
    n = 10_000
    rows = spark.range(n).selectExpr("if(id % 3 = 0, 0, id) AS conv_id", "id * 6 AS turn", "explode(sequence(0, 2)) AS k")
    name = "concat(turn, '-', k)"
    calls = rows.selectExpr("conv_id", "turn + 5 - 2 * k AS turn", "'assistant' AS role", f"""concat('{{"tool_calls":[{{"id":"', {name}, '","name":"fetch","arguments":{{"url":', if(k = 0, '"u"', concat('{{"$ref":"', turn, '-', k - 1, '"}}')), '}}}}]}}') AS text""")
    results = rows.selectExpr("conv_id", "turn + 4 - 2 * k AS turn", "'tool' AS role", f"""concat('{{"tool_call_id":"', {name}, '","content":1}}') AS text""")
    got = chat.link(calls.union(results), task_edges=20_000)
    assert got.groupBy("role", "status", "n_linked", "valid").count().count() == 2 and got.where("status = 'linked'").count() == 6 * n
    order = [json.loads(r.json) for r in got.where("conv_id = 7").orderBy("seq").collect()]
    assert [m.get("tool_call_id") or m["tool_calls"][0]["id"] for m in order] == [f"42-{k}" for k in (0, 0, 1, 1, 2, 2)]


def test_pii_spelled_out_addresses_of_any_length(spark):
    long = "a" * 90
    d = table(spark, [f"write to {long} [at] {'b' * 80} [dot] {'c' * 20} now", "mail joe [at] site [dot] org", "x [at] y"])
    found = d.select("doc_id", pii.candidates(F.col("text")).alias("c")).collect()
    got = {r.doc_id: [(s["start"], s["end"]) for s in (r.c["spans"] if "spans" in r.c else r.c)] for r in found}
    assert got[1] == [(9, 9 + 90 + 6 + 80 + 7 + 20)] and got[2] == [(5, 28)] and got[3] == []
