"""Toxicity, templates, URL rules, chat trees, personal data, and the pipeline."""

import hashlib
import re
import uuid

import duckdb
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from snaplake.llm import chat, decontaminate, lm, media, packing, pii, shared, simhash, toxicity, urls, windows

from .brute import edge_docs, prose

TOXIC = ("zorgish", "blarghead", "smeeface")


def toxic_docs(spark, n=600):
    rows = []
    for i in range(n):
        sentences = [prose(1000 + 7 * i + s, 9, 3000).capitalize() + "." for s in range(6)]
        bad = i % 4 == 0
        if bad:
            sentences[i % 6] = f"You {TOXIC[i % 3]} {prose(i, 4, 3000)}."
        rows.append((i, " ".join(sentences), int(bad)))
    return spark.createDataFrame(rows, "doc_id long, text string, toxic int")


def test_noisy_or_learns_words_and_finds_sentences(spark):
    docs = toxic_docs(spark)
    model = toxicity.fit(docs.select("doc_id", "text"), docs.select("doc_id", "toxic").where(~toxicity.held_out()))
    got = toxicity.score(docs.withColumn("SCORE", F.lit("old")), model)
    assert got.columns == ["doc_id", "text", "toxic", "score", "offending"]
    held = got.where(toxicity.held_out()).collect()
    assert len(held) > 100 and all((r["score"] >= 0.3) == bool(r["toxic"]) for r in held)
    for r in held:
        found = [r["text"].encode()[s["start"] : s["end"]].decode() for s in r["offending"]]
        assert all(any(t in x for t in TOXIC) for x in found) and len(found) == r["toxic"]
    kept = toxicity.reject(docs, docs.select("doc_id", "toxic"))
    assert {r["toxic"] for r in kept.collect()} == {0} and kept.columns == docs.columns


def test_toxicity_edges(spark):
    docs = edge_docs(spark)
    none = spark.createDataFrame([(1, None), (None, 1)], "doc_id long, toxic int")
    model = toxicity.fit(docs, none)
    got = toxicity.score(docs, model).collect()
    assert len(got) == docs.count() and all(0 <= r["score"] <= 1 and r["offending"] == [] for r in got)
    assert toxicity.score(docs.limit(0), model).count() == 0


ITEM = "Alice has 12 apples and gives Bob 5 kg of the red apples each day until the basket is empty at noon"
CASES = [
    (1, f"Some words before it. {ITEM}. And after", "exact"),
    (2, ITEM.upper(), "exact"),
    (3, ITEM.replace("Alice", "Carol").replace("12", "30").replace("Bob", "Dave").replace("5 kg", "7 pounds"), "reparameterised"),
    (4, ITEM.replace("Bob", "Alice").replace("5", "12"), None),
    (5, "has apples and gives some of the red apples", None),
    (6, None, None),
    (7, "", None),
    (8, prose(1, 30_000), None),
]


def test_templates_catch_changed_questions(spark):
    docs = spark.createDataFrame([(i, t) for i, t, _ in CASES] + [(1, CASES[0][1]), (None, ITEM)], "doc_id long, text string")
    items = spark.createDataFrame([(9, ITEM), (8, None), (7, ""), (6, "two words"), (None, ITEM)], "item_id long, text string")
    got = {r["doc_id"]: (r["item_id"], r["kind"]) for r in decontaminate.leaks(docs, items).collect()}
    assert got == {i: (9, kind) for i, _, kind in CASES if kind}
    left = decontaminate.reject(docs, items)
    assert sorted(r["doc_id"] or -1 for r in left.collect()) == [-1, 4, 5, 6, 7, 8]
    assert decontaminate.leaks(docs.limit(0), items).count() == 0 and decontaminate.leaks(docs, items.limit(0)).count() == 0


def test_leaks_whose_length_changed(spark):
    """A token put in or left out in the middle, slots of other lengths, names that start sentences."""
    plain = "the old ferry leaves the small harbour every single morning and carries letters flour salt and tools over to the quiet island beyond the long reef"
    names = "Bob buys apples at the market. Bob sells apples to his friend. Bob keeps apples for his mother."
    wide = "each worker named Bob carries 1000 stones of 5 kg up the hill before Bob rests and then counts 1000 stones again"
    items = spark.createDataFrame([(1, plain), (2, names), (3, wide)], "item_id long, text string")
    other = wide.replace("Bob", "Mary Ann").replace("1000", "2 500").replace("5 kg", "7")
    rows = [
        (1, plain.replace("morning and", "morning gladly and")), (2, plain.replace("morning and", "and")), (3, names.replace("Bob", "Tom")), (4, other),
        (5, names.replace("Bob", "Tom", 1)), (6, plain.split(" and ")[0]), (7, "so " + plain + " it is"),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {(r["doc_id"], r["item_id"]): r["kind"] for r in decontaminate.leaks(docs, items).collect()}
    assert got == {(1, 1): "exact", (2, 1): "exact", (3, 2): "reparameterised", (4, 3): "reparameterised", (5, 2): "exact", (7, 1): "exact"}


def test_leaks_of_few_literal_tokens(spark):
    """Copies of items that are nearly all numbers or names are found, other values are not."""
    sums = "12 + 7 - 40 = 19 then 3 * 5 + 8 = 23 and 77 - 6 = 71"
    items = spark.createDataFrame([(1, sums), (2, "see Anna Berta Clara Dora Emma Frieda Greta Hanna Ida"), (3, "7 kg")], "item_id long, text string")
    rows = [(1, f"Some text. {sums}. More"), (2, sums.replace("7", "9").replace("3", "4")), (3, "and see Anna Berta Clara Dora Emma Frieda Greta Hanna Ida"), (4, "about 7 kg of it"), (5, "about 8 kg of it")]
    got = {(r["doc_id"], r["item_id"]): r["kind"] for r in decontaminate.leaks(spark.createDataFrame(rows, "doc_id long, text string"), items).collect()}
    assert got == {(1, 1): "exact", (3, 2): "exact", (4, 3): "exact"}


def test_items_of_one_template_are_one_class(spark):
    """Many items and documents of one question give a row a document."""
    ask = "a farmer called {} has {} sheep and sells {} of them to his neighbour {} for a price of {} coins before the winter"
    fill = lambda i: ask.format(f"Name{'abcdefghij'[i % 10]}x", 100 + i, 3 + i, f"Other{'abcdefghij'[i // 10 % 10]}x", 7000 + i)
    other = ask.format("Bob", 5, 5, "Bob", 5)
    items = spark.createDataFrame([*((i, fill(i)) for i in range(1, 120)), (500, other)], "item_id long, text string")
    docs = spark.createDataFrame([*((i, f"so {fill(i + 40)} and on") for i in range(150)), (900, other)], "doc_id long, text string")
    got = decontaminate.leaks(docs, items)
    assert sorted((r["doc_id"], r["item_id"]) for r in got.collect()) == [*((i, 1) for i in range(150)), (900, 500)]
    assert {(r["item_id"], r["class_id"]) for r in decontaminate.classes(items).collect()} == {*((i, 1) for i in range(1, 120)), (500, 500)}


def brute_leaks(text, items, k=8, cover=0.5):
    """Items with half of their windows of k words in the text, for texts without any slot."""
    w = re.findall(r"[a-z]+", text)
    inside = {tuple(w[p : p + k]) for p in range(len(w) - k + 1)}
    out = set()
    for i, t in items:
        v = re.findall(r"[a-z]+", t)
        windows = [tuple(v[p : p + k]) for p in range(len(v) - k + 1)]
        if sum(x in inside for x in windows) >= cover * len(windows):
            out.add(i)
    return out


def test_leaks_equal_brute_force_without_slots(spark):
    import random

    r = random.Random(5)
    items = [(i, prose(700 + i, r.randint(12, 40), 900)) for i in range(30)]
    rows = []
    for d in range(120):
        v = items[r.randrange(30)][1].split()
        a = r.randrange(len(v))
        rows.append((d, f"{prose(d, 40, 900)} {' '.join(v[a : a + r.randint(1, len(v))])} {prose(d + 300, 40, 900)}"))
    got = {(x["doc_id"], x["item_id"]) for x in decontaminate.leaks(spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")).collect()}
    want = {(d, i) for d, t in rows for i in brute_leaks(t, items)}
    assert got == want and 10 < len(want) < 110


URLS = [
    None, "", "no scheme", "http://", "HTTP://WWW.Example.COM/en/x?q#f", "https://a.example.com/en/", "https://example.com/EN/", "https://com/", "https://x.com", "https://x.net/es/1", "ftp://net/fr/#a://b/",
    "https://spam-farm.org/", "https://notspam-farm.org/", "https://spam-farms.org/", "https://docs.spam-farm.org/a", "https://x.org/online-casino?x", "https://x.org/casinos", "https://x.org/?a=1&sessionid=deadbeef99",
    "https://x.org/tag/red/page/12", "https://x.org/tag/page/12", "https://x.org/f.exe?x", "https://x.org/wp-login.php", "https://x.org/wp-login-php", "https://x.org/replica-bags", "https://x.org/?utm_source=feed&ref=1", "https://É.org/x",
]


def test_url_rules_equal_sql_and_all_expressions(spark, tmp_path):
    pages = spark.createDataFrame([(i, u, "r", "p") for i, u in enumerate(URLS)] + [(4, URLS[4], "r", "p")], "page_id long, url string, rule string, path string")
    got = urls.judge(pages).select("page_id", "host", "path", "rule", "verdict", "pattern")
    c = duckdb.connect()
    frame = pages.select("page_id", "url").toPandas()
    c.register("pages", frame)
    want = c.execute(urls.op6_sql()).fetchall()
    key = lambda rows: sorted(tuple("" if x is None else str(x) for x in r) for r in rows)
    assert key(got.collect()) == key(want)
    for r in got.collect():
        lu = (URLS[r["page_id"]] or "").translate(str.maketrans(urls.UPPER, urls.LOWER))
        hits = [p for _, p in urls.PATTERN_RULES if re.search(p, lu, re.ASCII)]
        assert r["pattern"] == (hits[0] if hits else None)
    assert urls.judge(pages.limit(0)).count() == 0 and urls.judge(pages, pattern_rules=()).count() == len(URLS) + 1


def test_chat_tree(spark):
    deep = [(20, t, "user" if t % 2 == 0 else "assistant", f"t{t}") for t in range(300)]
    rows = [(1, 0, "system", "be <|kind|>"), (1, 1, "user", "hi"), (1, 2, "assistant", "[INST] \\l </s>"), (2, 0, "system", "be <|kind|>"), (2, 1, "user", "hi"), (2, 2, "assistant", "other"),
            (3, 0, "system", "be <|kind|>"), (3, 1, "user", "bye"), (4, 0, "assistant", None), (5, 0, None, ""), (6, 1, "user", "same"), (6, 1, "user", "same"), (None, 0, "user", "lost"), (7, None, "a|b\n", "x" * 50_000), *deep, *[(21, *r[1:]) for r in deep[:200]], (21, 200, "user", "fork")]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(3)
    path = f"{shared.shared_folder(spark)}/chat-{uuid.uuid4().hex}"
    ways = chat.build(turns.withColumn("node", F.lit(1)).withColumn("N_WAYS", F.lit("x")), path)
    tree = spark.read.parquet(f"{path}/tree")
    got = {r["conv_id"]: r for r in chat.read_back(ways, tree).collect()}
    convs = {}
    for c, t, role, text in sorted(rows, key=lambda r: (r[0] or -1, -1 if r[1] is None else r[1], r[2] or "", r[3] or "")):
        convs.setdefault(c, []).append((role or "", text or ""))
    assert set(got) == set(convs)
    for c, said in convs.items():
        loss = "".join(t for r, t in said if r == "assistant")
        assert got[c]["n_turns"] == len(said) and got[c]["formatted_chars"] == sum(len(chat.segment(r, t)[0]) for r, t in said)
        assert got[c]["turns_sha256"] == hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in said).encode()).hexdigest()
        assert (got[c]["loss_chars"], got[c]["loss_sha256"]) == (len(loss), hashlib.sha256(loss.encode()).hexdigest())
    nodes = tree.orderBy("offset").collect()
    prefixes = {tuple(s[: k + 1]) for s in convs.values() for k in range(len(s))}
    assert len(nodes) == len(prefixes)
    end = 0
    for n in nodes:
        assert n["offset"] == end and n["position"] == sum(a["end"] - a["start"] for a in n["ancestors"])
        assert all(a["end"] <= n["offset"] for a in n["ancestors"])
        end += n["n_chars"]
    # Depth-first: when a node begins, the last one with its parent's end of way is still open.
    open_nodes = []
    for n in nodes:
        while open_nodes and open_nodes[-1] != n["parent"]:
            open_nodes.pop()
        assert bool(open_nodes) == (n["parent"] is not None)
        open_nodes.append(n["node"])
    control = re.compile(r"</s>|\[/?INST\]|<\|")
    assert not any(control.search(s[a:b]) for r, t in (x for v in convs.values() for x in v) for s, a, b in [chat.segment(r, t)])
    assert chat.build(turns.limit(0), path + "-empty").count() == 0


def test_a_chat_tree_is_depth_first_at_any_depth(spark, monkeypatch):
    """Ways that fork after 1 500 common turns, and nodes on more ways than a key takes."""
    monkeypatch.setattr(chat, "WAYS", 2)
    rows = [(c, t, "user", f"turn {t}" if t < 1500 or t % 7 else f"turn {t} of {c % 3}") for c in range(7) for t in range(1500 + 20 * c)]
    path = f"{shared.shared_folder(spark)}/chat-{uuid.uuid4().hex}"
    ways = chat.build(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"), path)
    tree = spark.read.parquet(f"{path}/tree")
    open_nodes = []
    for n in tree.orderBy("offset").select("node", "parent").collect():
        while open_nodes and open_nodes[-1] != n["parent"]:
            open_nodes.pop()
        assert bool(open_nodes) == (n["parent"] is not None)
        open_nodes.append(n["node"])
    assert {r["conv_id"]: r["n_turns"] for r in chat.read_back(ways, tree).collect()} == {c: 1500 + 20 * c for c in range(7)}


PATTERNS = (
    re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"), re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"), re.compile(r"[0-9]([\x20-]?[0-9])+"), re.compile(r"\+[0-9][\x20().0-9-]+[0-9]"),
)


def luhn(d):
    return sum((x * 2 - 9 * (x > 4)) if k % 2 else x for k, x in enumerate(map(int, reversed(d)))) % 10 == 0


def plain_spans(t):
    out = []
    for k, p in enumerate(PATTERNS):
        for m in p.finditer(t):
            d = re.sub("[^0-9]", "", m[0])
            if (k == 0, k == 1 and all(int(x) <= 255 for x in m[0].split(".")), k == 2 and 12 <= len(d) <= 19 and luhn(d), k == 3 and 9 <= len(d) <= 15)[k]:
                out.append((m.start(), k, m.end()))
    return sorted(out)


def test_base_spans_equal_the_patterns():
    import random

    r = random.Random(3)
    parts = ["a", "@", ".", "1", "2", "+", "-", " ", "(", "x.y", "192.168.001.1", "4111111111111111", "4111 1111-1111 1111", "b@c.de", "+1 (", "é", "256.1.1.1", "%"]
    for _ in range(5000):
        t = "".join(r.choice(parts) for _ in range(r.randint(0, 25)))
        assert pii.base_spans(t) == plain_spans(t), t
    for long in ("1" * 200_000, "a" * 200_000 + "@", "1." * 50_000, "+1 " + " " * 100_000):
        pii.base_spans(long)


def secrets(spark):
    rows = [(i, f"{prose(i, 30, 400)} call Quillon at the Harrowgate office bob{i % 2}@mail.org please {prose(i + 99, 30, 400)}") for i in range(12)]
    rows += [(100 + i, prose(500 + i, 60, 400) + " call at the office please") for i in range(60)]
    return spark.createDataFrame(rows, "doc_id long, text string").repartition(3)


def test_terms_that_disclose_are_found_and_replaced(spark):
    docs = secrets(spark)
    found = pii.find(docs, support=3, generalise_at=0.6, remove_at=0.99)
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    for r in found.collect():
        t = texts[r["doc_id"]]
        assert [(s["start"], s["kind"], s["end"]) for s in r["spans"] if s["kind"] < 4] == plain_spans(t)
        terms = {t[s["start"] : s["end"]].lower() for s in r["spans"] if s["kind"] == 4}
        assert not terms & {"call", "at", "the", "please"}
        assert ({"quillon", "harrowgate"} <= terms) == (r["doc_id"] < 100)
    clean = {r["doc_id"]: r["text"] for r in pii.sanitise(docs, generalise_at=0.6, remove_at=2.0).collect()}
    assert len(clean) == len(texts) and all(clean[i] == t for i, t in texts.items() if i >= 100)
    assert all("[EMAIL]" in clean[i] and "Quillon" not in clean[i] and "[TERM]" in clean[i] and "@" not in clean[i] for i in range(12))


def test_terms_are_replaced_in_the_whole_text(spark):
    far = F.concat("text", F.lit(" " + "the " * 30 + "Quillon quillon"))
    docs = secrets(spark).withColumn("text", F.when(F.col("doc_id") < 100, far).otherwise(F.col("text")))
    clean = {r["doc_id"]: r["text"] for r in pii.sanitise(docs, generalise_at=0.6, remove_at=2.0).collect()}
    assert all("quillon" not in clean[i].lower() and clean[i].endswith("the [TERM] [TERM]") for i in range(12))


def test_a_sentence_of_many_items_fetches_no_documents(spark):
    """1 000 items begin with one sentence, which stands in 300 documents without any item: only
    documents with the rest of an item are leaks, whatever they begin with."""
    head = "Read the text below with great care and then answer the following question in full"
    items = [(i, f"{head}: {prose(5000 + i, 22, 9000)}.") for i in range(1000)]
    docs = [(i, f"{prose(i, 40, 9000)}. {head}. {prose(9000 + i, 30, 9000)}") for i in range(300)]
    docs += [(1000 + i, f"{prose(i, 10, 9000)} {items[i * 7][1]}") for i in range(9)] + [(2000, items[3][1].split(": ")[1]), (2001, None), (2002, head)]
    d, b = spark.createDataFrame(docs, "doc_id long, text string").repartition(4), spark.createDataFrame(items, "item_id long, text string")
    got = {(r["doc_id"], r["item_id"]) for r in decontaminate.leaks(d, b).collect()}
    assert got == {(1000 + i, i * 7) for i in range(9)} | {(2000, 3)}


def brute_terms(rows, support, generalise_at):
    """(id, term) by plain counting: texts with value and term, of three or more texts."""
    import collections
    import math

    lower = lambda t: t.translate(str.maketrans(urls.UPPER, urls.LOWER))
    held, free, n_t = {}, {}, collections.Counter()
    for i, t in rows:
        n_t.update(set(re.findall(r"[a-z]+", lower(t))))
        spans = plain_spans(t)
        held[i] = {lower(t[a:b]) for a, _, b in spans}
        free[i] = {m[0] for m in re.finditer(r"[a-z]+", lower(t)) if all(m.end() <= a or m.start() >= b for a, _, b in spans)}
    out, n = set(), len(rows)
    for e in set().union(*held.values()):
        own = [i for i in held if e in held[i]]
        met = collections.Counter(w for i in own for w in free[i])
        told = {w for w, c in met.items() if c >= support and math.log(c * n / (n_t[w] * len(own))) / math.log(n / len(own)) >= generalise_at}
        out |= {(i, w) for i in own for w in told & free[i]}
    return out


def test_many_values_of_one_text(spark):
    """Four texts share 3 000 addresses and their own words: the addresses are one class, so the
    words are counted once and not 3 000 times; a fifth text has half of the addresses."""
    mails = [f"m{i}x@mail{i % 7}.org" for i in range(3000)]
    rows = [(i, " ".join([*mails, prose(900 + i, 300, 3000), "zedring quaxle"])) for i in range(4)] + [(4, " ".join([*mails[:1500], prose(950, 30, 3000), "quaxle"]))]
    rows += [(10 + i, prose(2000 + i, 60, 3000)) for i in range(300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    text = dict(rows)
    got = {(r["doc_id"], text[r["doc_id"]][s["start"] : s["end"]]) for r in pii.find(docs).collect() for s in r["spans"] if s["kind"] == 4}
    assert {(i, w) for i in range(4) for w in ("zedring", "quaxle")} | {(4, "quaxle")} <= got
    few = [(i, t if i > 4 else " ".join(w for w in t.split() if "@" not in w or w in (mails[0], mails[2000]))) for i, t in rows]
    assert got == {(i, w) for i, w in brute_terms(few, 3, 0.8)}


def test_terms_equal_brute_force(spark):
    rows = [(r["doc_id"], r["text"]) for r in secrets(spark).collect()] + [(300 + i, f"{prose(800 + i, 50, 300)} Zed{'abc'[i % 3]} ring +49 30 901820{i % 3} or bob1@mail.org") for i in range(15)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    text = dict(rows)
    for at in (0.6, 0.9):
        got = {(r["doc_id"], text[r["doc_id"]][s["start"] : s["end"]].lower()) for r in pii.find(docs, generalise_at=at).collect() for s in r["spans"] if s["kind"] == 4}
        want = brute_terms(rows, 3, at)
        assert got == want and want


CLASHES = "score string, Offending string, _id string, _base string, _near string, _url string, _Gone string, row string, _text string, _twin string, spans2 string, __gone string"


def test_columns_of_any_name_stay(spark):
    names = [c.split()[0] for c in CLASHES.split(", ")]
    docs = toxic_docs(spark, 80).select("doc_id", "text", "toxic")
    labels = docs.select("doc_id", "toxic")
    docs = docs.drop("toxic").withColumns({n: F.concat(F.lit(f"{n} "), F.col("doc_id").cast("string")) for n in names})
    docs = docs.union(docs.limit(1)).unionByName(secrets(spark).withColumn("doc_id", F.col("doc_id") + 5000).withColumns({n: F.lit("x") for n in names}))
    items = spark.createDataFrame([(1, docs.orderBy("doc_id").first()["text"])], "item_id long, text string")
    for kept in (toxicity.reject(docs, labels), simhash.keep_one(docs), decontaminate.reject(docs, items), pii.sanitise(docs)):
        assert kept.columns == docs.columns
        rest = [c for c in docs.columns if c != "text"]
        assert kept.select(rest).exceptAll(docs.select(rest)).count() == 0 and kept.count() > 0
    found = pii.find(docs)
    assert found.columns == [*[c for c in docs.columns if c != "text"], "spans"] and found.count() == docs.count()
    removed = windows.remove_repeated(docs)
    assert removed.columns == [*[c for c in docs.columns if c != "text"], "n_words", "n_removed", "kept"] and removed.count() == docs.count()
    pages = docs.select(F.col("doc_id").alias("page_id"), F.lit("http://spam-farm.org/").alias("url"), *names)
    judged = urls.judge(pages)
    assert judged.select(names).exceptAll(pages.select(names)).count() == 0 and {r["verdict"] for r in judged.collect()} == {"block"}
    # Operators that look at their own columns alone give the same with clashing ones beside them.
    bare = docs.select("doc_id", "text")
    assert decontaminate.leaks(docs, items).exceptAll(decontaminate.leaks(bare, items)).count() == 0
    assert lm.score(docs).exceptAll(lm.score(bare)).count() == 0
    assert packing.pack(docs, packing.word_tokenizer()).select("doc_id", "piece", "length").exceptAll(packing.pack(bare, packing.word_tokenizer()).select("doc_id", "piece", "length")).count() == 0
    one, two = (media.round_trip(d, f"{shared.shared_folder(spark)}/media-{uuid.uuid4().hex}") for d in (docs.withColumn("FILE", F.lit(1)), bare))
    assert one.exceptAll(two).count() == 0


def noisy_or(text, model):
    """The score of one text, sentence by sentence, by the model's weights."""
    import numpy as np
    import pyarrow as pa

    from snaplake.llm import textblocks

    at, no = dict(zip(model.words.tolist(), model.weights.tolist(), strict=True)), 1 - model.leak
    for sentence in re.split(r"[.!?\n]", text or ""):
        told = set()
        for w in re.findall(r"[A-Za-z]+", sentence):
            for k in (0, *toxicity.STEMS):
                if not k or len(w) > k:
                    h = textblocks.split(pa.array([w[: k or None].lower()])).hashes()[0] ^ np.uint64(k)
                    told |= {int(h)} & at.keys()
        if told:
            no *= 1 - 1 / (1 + np.exp(-(model.bias + sum(at[h] for h in told))))
    return 1 - no


def test_scores_equal_a_plain_noisy_or(spark):
    docs = toxic_docs(spark, 200)
    model = toxicity.fit(docs.select("doc_id", "text"), docs.select("doc_id", "toxic"))
    assert len(model.words)
    for r in toxicity.score(docs, model).collect():
        assert r["score"] == pytest.approx(noisy_or(r["text"], model), abs=1e-9)


def test_pii_edges(spark):
    docs = edge_docs(spark, "spans string, base string, near string")
    got = pii.find(docs)
    assert got.columns == ["doc_id", "base", "near", "spans"] or set(got.columns) >= {"doc_id", "spans"}
    assert got.count() == docs.count() and got.where(F.size("spans") > 0).count() == 0
    same = pii.sanitise(docs)
    assert same.columns == docs.columns and same.exceptAll(docs).count() == 0
    assert pii.find(docs.limit(0)).count() == 0 and pii.sanitise(docs.limit(0)).count() == 0


def test_pipeline_stages_on_small_tables(spark):
    d = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{d}/documents.parquet")
    n = docs.count()
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = shared.written(stage(spark, docs, d), name)
        assert out.columns == docs.columns and 0.5 * n < out.count() <= docs.count()
        docs = out
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, d)
    assert {r["doc_id"] for r in packed.collect()} == {r["doc_id"] for r in docs.collect()}


@pytest.mark.parametrize("stage", range(5))
def test_pipeline_stages_take_edge_rows(spark, stage):
    docs = edge_docs(spark, "source string, n_chars string, lang string")
    out = corpus_pipeline.STAGES[stage][1](spark, docs, "/root/testdata/sf0.001")
    assert out.count() > 0
    assert corpus_pipeline.STAGES[stage][1](spark, docs.limit(0), "/root/testdata/sf0.001").count() == 0
