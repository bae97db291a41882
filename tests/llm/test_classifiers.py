"""Language and toxicity by held-out accuracy; leaks, pages, quotations and fingerprints by brute force."""

import hashlib
import html
import re

from pyspark.sql import functions as F

from glossaflow.llm import decontamination, html_extraction, language_id, order_minhash, quotations, toxicity
from glossaflow.llm.common import held_out, table

SF = "/root/testdata/sf0.01"


def test_language_of_held_out_documents(spark):
    docs = table(spark, SF, "documents").select("doc_id", "text", "lang")
    models = language_id.fit(docs, ~held_out("doc_id", 4, 2), sample_chars=300_000)
    odd = spark.createDataFrame([(-1, None, "en"), (-2, "", "en"), (-3, "12 -- ²", None), (-4, "xqzvw kkjq zzxv wwq " * 30, None)],
                                "doc_id long, text string, lang string")
    rows = language_id.identify(docs.union(odd).withColumn("score", F.lit("clash")), models).collect()
    by_id = {r["doc_id"]: r for r in rows}
    held = [r for r in rows if r["doc_id"] >= 0]
    assert sum(r["lang_pred"] == r["lang"] for r in held) > 0.97 * len(held)
    assert sum(r["rejected"] for r in held) < 0.01 * len(held)
    assert all(by_id[i]["lang_pred"] == "und" and by_id[i]["rejected"] and by_id[i]["score"] == 0 for i in (-1, -2, -3))
    assert by_id[-4]["rejected"]
    nothing = language_id.fit(docs.limit(0), F.lit(True))
    assert {r["lang_pred"] for r in language_id.identify(odd, nothing).collect()} == {"und"}


def test_sample_bound_holds_for_copies_null_ids_and_long_texts(spark):
    rows = [(None, f"{i} " + "word " * 20, "a") for i in range(300)] + [(7, "the same again " * 10, "a")] * 500
    rows += [(None, "copy " * 300, "b")] * 50 + [(1, "x" * 5000, "c"), (2, "", "d"), (3, None, "d"), (4, "e", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    drawn = language_id.sample(docs, F.lit(True), "lang", "text", 2000).collect()
    assert len({(r["label"], r["text"]) for r in drawn}) == len(drawn)
    chars = {name: sum(len(r["text"]) for r in drawn if r["label"] == name) for name in "abcd"}
    assert 1000 < chars["a"] <= 2000 and chars["b"] == 1500 and chars["c"] == chars["d"] == 0
    assert language_id.sample(docs.limit(0), F.lit(True), "lang", "text").count() == 0


def test_probabilities_of_a_context_sum_to_one():
    models = language_id.Models.train({("a", "abab"): 3, ("a", "ba"): 2, ("b", "cc"): 1}, order=3)
    words = [f"ab{c}" for c in "abcdefgh"]
    scores = models.score_words(["ab", *words])
    assert scores.shape == (9, 3) and (scores[:, :2] < 0).all()


def test_toxicity_of_held_out_documents(spark):
    docs = table(spark, SF, "documents").select("doc_id", "text")
    labels = table(spark, SF, "labels")
    model = toxicity.fit(docs, labels, ~held_out("doc_id", 5, 0))
    odd = spark.createDataFrame([(-1, None), (-2, ""), (-3, "you total idiot you moron " * 5)], "doc_id long, text string")
    both = docs.union(odd).withColumn("probability", F.lit(1))
    rows = {r["doc_id"]: r for r in toxicity.score(both, model).collect()}
    truth = {r["doc_id"]: r["toxic"] for r in labels.collect()}
    right = sum(rows[i]["predicted"] == t for i, t in truth.items())
    assert right > 0.9 * len(truth)  # 320 labels to learn from
    assert all(0 <= r["score"] <= 1 for r in rows.values())
    assert rows[-1]["predicted"] == rows[-2]["predicted"] == 0
    constant = toxicity.fit(docs, labels.limit(0), F.lit(True))
    assert {r["score"] for r in toxicity.score(odd, constant).collect()} == {0.0}


def test_leaks_with_substitutions(spark):
    items = [(1, "The quick brown fox jumps over the lazy dog near the old river bank today at noon"), (2, "two words"),
             (3, "short item here now"), (4, None), (5, "")]
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    words = items[0][1].split()
    changed = [w if i not in (3, 9, 14) else "other" for i, w in enumerate(words)]
    docs = [(1, "x " * 50 + items[0][1] + " y" * 9), (2, " ".join(changed)), (3, " ".join(words[:6])), (4, None), (5, ""),
            (6, "so SHORT item, here now!"), (7, "two words"), (8, " ".join(reversed(words)))]
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    found = {(r["doc_id"], r["item_id"]): (r["start"], r["n_equal"]) for r in
             decontamination.find_leaks(frame, benchmark).collect()}
    assert found == {(1, 1): (50, 17), (2, 1): (0, 14), (6, 3): (1, 4)}
    kept = decontamination.drop_leaking(frame, benchmark)
    assert sorted(r["doc_id"] for r in kept.collect()) == [3, 4, 5, 7, 8]
    assert decontamination.find_leaks(frame, benchmark.limit(0)).collect() == []


def test_leaks_in_blocks(spark, monkeypatch):
    docs, benchmark = table(spark, SF, "documents"), table(spark, SF, "benchmark")
    whole = {tuple(r) for r in decontamination.find_leaks(docs, benchmark).collect()}
    monkeypatch.setattr(decontamination, "BLOCK_TOKENS", 500)
    assert {tuple(r) for r in decontamination.find_leaks(docs, benchmark).collect()} == whole and whole
    texts = {r["doc_id"]: " ".join(re.findall(r"[^\W_]+", r["text"].lower())) for r in docs.collect()}
    items = {r["item_id"]: " ".join(re.findall(r"[^\W_]+", r["text"].lower())) for r in benchmark.collect()}
    exact = {(d, i) for d, t in texts.items() for i, x in items.items() if f" {x} " in f" {t} "}
    assert exact <= {(d, i) for d, i, *_ in whole}


def test_pages(spark):
    menu = "<div class='x9'><p>Always the same line</p></div>"
    rows = [(i, f"http://h.example/{i}", f"<html><head><title>t</title></head><body><nav>menu</nav>{menu}"
             f"<div class=body><h1>Title {i}</h1><p>Body <b>of</b>\n  {i} &amp; more<p>Second<br>line {i}</div>"
             f"<div class='ad'>buy {i}</div><footer>foot</footer><script>var a='</p>';</script></body></html>")
            for i in range(30)]
    rows += [(100, None, None), (101, "x", ""), (102, "http://one.example/", "<article><p>A</article><p>outside"),
             (103, "http://two.example/", "plain &lt;text&gt; <b>here"), (104, "http://two.example/", "<p><!-- c")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    found = {r["page_id"]: r for r in html_extraction.extract(pages).collect()}
    assert all(found[i]["text"] == f"Title {i}\nBody of {i} & more\nSecond line {i}" for i in range(30))
    assert [found[i]["text"] for i in range(100, 105)] == ["", "", "A", "plain <text> here", ""]
    assert all(r["n_chars"] == len(r["text"]) for r in found.values())
    assert html_extraction.extract(pages.limit(0)).collect() == []


def test_articles_of_the_given_pages(spark):
    pages = table(spark, SF, "pages")
    found = {r["page_id"]: r["text"] for r in html_extraction.extract(pages).collect()}
    for row in pages.collect():
        inside = re.search(r"<article>(.*)</article>", row["html"], re.S)[1]
        parts = re.split(r"</?p>|</?h1>", re.sub(r"</?b>", "", inside))
        clean = [re.sub(r"\s+", " ", html.unescape(re.sub(r"<[^>]+>", " ", p))).strip() for p in parts]
        assert found[row["page_id"]] == "\n".join(p for p in clean if p)


def test_quotations(spark):
    rows = [(1, 0, "user", "How do I sort\na list?"), (1, 1, "assistant", "Use sorted."),
            (1, 2, "user", "Bob wrote:\n> how do I  SORT\n> a list?\n\nSame question."),
            (2, 0, "user", "> > Use sorted.\n> Same question.\nThanks!"), (3, 0, "user", None), (3, 1, None, ""),
            (4, 0, "user", "> Thanks!\nindeed"), (None, 0, "user", "> Thanks!"), (5, 0, "user", "> never said\nwhat?")]
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    found = {(r["conv_id"], r["turn"]): r for r in quotations.chat_messages(frame).collect()}
    assert len(found) == len(rows)
    reply = lambda k: (found[k]["reply_to_conv"], found[k]["reply_to_turn"])
    assert reply((1, 2)) == (1, 0) and reply((1, 1)) == (1, 0) and reply((2, 0)) == (1, 2) and reply((5, 0)) == (None, None)
    assert found[1, 2]["content"] == "Same question." and found[2, 0]["content"] == "Thanks!"
    assert [(found[k]["thread_id"], found[k]["depth"]) for k in ((1, 0), (2, 0), (4, 0), (5, 0))] == [
        (1, 0), (1, 1), (1, 2), (5, 0)]
    assert found[2, 0]["quote_level"] == 2 and found[3, 0]["content"] == "" and found[3, 1]["chat"].startswith("<|user|>")
    assert quotations.chat_messages(frame.limit(0)).collect() == []


def plain_signatures(text):
    import re as _re

    tokens = _re.findall(r"\S{1,8}", text)
    kmers = [tuple(tokens[i : i + order_minhash.K]) for i in range(max(1, len(tokens) - order_minhash.K + 1))] if tokens else []
    seen, found = {}, []
    for kmer in kmers:
        seen[kmer] = seen.get(kmer, -1) + 1
        found.append((kmer, seen[kmer]))
    return found


def test_fingerprints(spark):
    rows = [(5, "one two three four five six seven eight nine ten"), (4, "one two three four five six seven eight nine ten"),
            (3, None), (2, ""), (1, "a b " * 200), (0, "日本語のとても長い文章です" * 9)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    found = {r["doc_id"]: r for r in order_minhash.fingerprints(docs).collect()}
    ids = [r[0] for r in rows]
    texts = {i: t or "" for i, t in rows}
    for i, after in zip(ids, ids[1:] + ids[:1]):
        size = len(texts[i]) // 3
        edited = texts[i][: len(texts[i]) - size] + texts[after][:size]
        assert found[i]["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest()
        assert found[i]["n_chars"] == len(texts[i])
        assert 0 <= found[i]["near_edited"] <= 1 and 0 <= found[i]["near_next"] <= 1
    assert found[5]["fingerprint"] == found[4]["fingerprint"] and found[5]["near_next"] == 1
    assert found[3]["near_edited"] == found[3]["near_next"] == 1
    # As many bins are filled as elements (k-mers by occurrence) can fill; repeated k-mers count each time.
    filled = lambda f: sum(f[i : i + 4] != "----" for i in range(0, len(f), 4))
    assert filled(found[5]["fingerprint"]) <= len(plain_signatures(texts[5]))
    assert filled(found[1]["fingerprint"]) > 50
    swapped = spark.createDataFrame([(1, "a b c d e f g h"), (2, "e f g h a b c d")], "doc_id long, text string")
    assert all(r["near_next"] < 1 for r in order_minhash.fingerprints(swapped).collect())
    assert order_minhash.fingerprints(docs.limit(0)).collect() == []
