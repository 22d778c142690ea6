"""Classifier, rules, mixing, packing, pages and chat on small inputs."""

import functools
import hashlib
import os
import zlib

import numpy as np
import pytest

from lacuna.llm import chat_format, html_text, mixing, packing, quality_model, quality_rules


# ------------------------------------------------------------------ classifier
def test_classifier_held_out_accuracy(spark, sf_small):
    out = quality_model.op2_quality_classifier(spark, sf_small.replace("0.001", "0.01"))
    labels = spark.read.parquet(sf_small.replace("0.001", "0.01") + "/labels.parquet")
    rows = out.join(labels, "doc_id").where("held_out").collect()
    assert len(rows) > 80
    assert np.mean([r["predicted"] == r["quality"] for r in rows]) > 0.95
    assert all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.5) for r in rows)


def test_classifier_odd_rows_and_reruns(spark, odd_docs, odd_rows):
    labels = spark.createDataFrame([(i, i % 2) for i in range(12)] + [(3, None), (None, 1)],
                                   "doc_id long, quality int")
    names = ("__score", "__predicted")
    a, b = (quality_model.classify(odd_docs, labels, odd_docs.columns, names=names).collect()
            for _ in range(2))
    assert len(a) == len(odd_rows)
    assert sorted(r["__score"] for r in a) == sorted(r["__score"] for r in b)
    assert all(0 <= r["__score"] <= 1 for r in a)


@pytest.mark.parametrize("labels", [[], [(0, 1), (2, 1)]])
def test_classifier_without_two_classes(spark, odd_docs, labels):
    df = spark.createDataFrame(labels, "doc_id long, quality int")
    scores = {r["score"] for r in quality_model.classify(odd_docs, df, ["doc_id"]).collect()}
    assert len(scores) == 1 and 0 < scores.pop() < 1


def test_classifier_empty(spark, no_docs):
    df = spark.createDataFrame([], "doc_id long, quality int")
    assert quality_model.classify(no_docs, df, ["doc_id"]).count() == 0


# ------------------------------------------------------------------ rules
def test_ablations_count_what_a_rule_alone_removes(spark, odd_docs):
    led = quality_rules.ledger(quality_rules.measure(odd_docs))
    rows = led.collect()
    mask = quality_rules.FULL.mask()
    for r in quality_rules.ablations(led, quality_rules.FULL).collect():
        bit = 1 << [n for n, _ in quality_rules.RULES].index(r["rule"])
        assert r["n_failed"] == sum(bool(x["fail_bits"] & bit) for x in rows)
        assert r["n_only_this"] == sum(x["fail_bits"] & mask == bit for x in rows)


# ------------------------------------------------------------------ mixing
def test_mix_meets_its_targets(spark, odd_docs):
    got = mixing.mix(odd_docs).collect()
    assert all(0 <= r["taken"] <= 2 * r["size"] for r in got)
    for key in {(r["source_size"], r["target"]) for r in got}:
        rows = [r for r in got if (r["source_size"], r["target"]) == key]
        assert abs(sum(r["taken"] for r in rows) - key[1]) < len(rows) + 1
    mixed = mixing.mixed(odd_docs)
    assert mixed.columns == odd_docs.columns
    words = sum(len((r["text"] or "").encode().split()) for r in mixed.collect())
    assert words == sum(r["taken"] for r in got)


def whole_mix(rows, targets):
    """(id, text, source) of the mix in whole documents; ``targets`` by source: its size and target."""
    def h(s):
        return int(hashlib.md5(s.encode()).hexdigest()[:15], 16)

    out = []
    for source, (size, target) in targets.items():
        full = int(size > 0 and target >= size)
        rest, groups = int(target) - full * size, {}
        for r in rows:
            if r[2] == source and words_of(r[1]):
                i = "" if r[0] is None else str(r[0])
                groups.setdefault((h(i), h(f"{i}\n{r[1]}")), []).append(r)
        for at in sorted(groups):
            out += groups[at] * full
            n = sum(map(words_of, (r[1] for r in groups[at])))
            if rest > 0 and 2 * rest >= n:
                out += groups[at]
            rest = rest - n if rest >= n else 0
    return sorted(out, key=str)


def words_of(text):
    return len((text or "").encode().split())


def whole_targets(rows, docs):
    by_id = {(r[0], words_of(r[1])): r[2] for r in rows}
    return {by_id[r["doc_id"], r["size"]]: (r["source_size"], r["target"])
            for r in mixing.mix(docs).collect()}


def test_whole_mix_cuts_no_text(spark, odd_docs, odd_rows):
    mixed = mixing.mixed_whole(odd_docs)
    assert mixed.columns == odd_docs.columns
    got = sorted(((r["doc_id"], r["text"], r["source"]) for r in mixed.collect()), key=str)
    assert got == whole_mix(odd_rows, whole_targets(odd_rows, odd_docs))


def test_whole_mix_of_null_ids(spark):
    rows = [(None, " ".join(f"w{i}" for _ in range(1 + i % 5)) + f" e{i}", s)
            for s in "abc" for i in range(60)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(3)
    got = sorted((tuple(r) for r in mixing.mixed_whole(df).collect()), key=str)
    sizes = {s: sum(words_of(t) for _, t, x in rows if x == s) for s in "abc"}
    target = {r["source"]: r["target"] for r in mixing.targets(spark.createDataFrame(
        list(sizes.items()), "source string, source_size long")).collect()}
    assert got == whole_mix(rows, {s: (sizes[s], target[s]) for s in "abc"})
    for s in "abc":
        assert abs(sum(words_of(t) for _, t, x in got if x == s) - target[s]) <= 4
    assert mixing.mixed_whole(df.limit(0)).count() == 0


# ------------------------------------------------------------------ packing
@functools.cache
def tokenizer():
    import public_tokenizers as P
    from tokenizers import Tokenizer
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    return Tokenizer.from_file(P.path("word_bpe_49k.json"))


def direct_ids(text):
    return tokenizer().encode(text or "", add_special_tokens=False).ids + [1]


def check_packed(rows, capacity):
    by = {}
    for r in rows:
        by.setdefault(r["sequence_id"], []).append(r)
    short = []
    for s in by.values():
        at = 0
        for r in sorted(s, key=lambda r: r["offset"]):
            assert r["offset"] == at
            at += r["length"]
        assert at <= capacity
        short.append(capacity - at)
    assert sorted(by) == list(range(len(by)))
    return short


def test_packing_odd_rows(spark, odd_docs, odd_rows):
    rows = packing.pack(odd_docs, with_ids=True).collect()
    check_packed(rows, 2048)
    want = {}
    for i, t, _ in odd_rows:
        want.setdefault((i, len(direct_ids(t))), []).append(direct_ids(t))
    pieces = {}
    for r in rows:
        pieces.setdefault((r["doc_id"], r["doc_tokens"]), []).append(r)
    assert {k: len(v) for k, v in want.items()} == {
        k: sum(r["start"] == 0 for r in v) for k, v in pieces.items()}
    for k, v in pieces.items():
        ids = {}
        for r in v:
            assert zlib.crc32(r["ids"]) == r["ids_crc32"] and len(r["ids"]) == 4 * r["length"]
            ids[r["start"]] = np.frombuffer(r["ids"], "<u4").tolist()
        assert sum((ids[s] for s in sorted(ids)), []) == want[k][0]


def test_word_ids_equal_the_tokenizer():
    import public_tokenizers as P
    path = P.path("word_bpe_49k.json")
    texts = ["Don't we'll 12ab_c  x\ty", "a<|endoftext|>b <|startoftext|>", "İX Å Å ΣαΣ",
             "\U0001f642 中文 é́", "\x00\x1c\x7f\x85\xa0q", "", None,
             *[f"{chr(c)}a a{chr(c)}{chr(c)}'s" for c in range(1, 0x500)]]
    got = packing.WordIds(path).of(texts)
    for t, ids in zip(texts, got):
        assert np.frombuffer(ids, "<u4").tolist() + [1] == direct_ids(t)


def test_best_filling_equals_all_choices():
    rng = np.random.default_rng(5)
    for _ in range(60):
        counts = {int(x): int(rng.integers(1, 4)) for x in rng.integers(1, 30, 5)}
        room = int(rng.integers(1, 70))
        sums = {0}
        for x, n in counts.items():
            sums = {s + x * k for s in sums for k in range(n + 1)}
        chosen = packing.best_filling(counts, room)
        assert all(n <= counts[x] for x, n in chosen.items())
        assert sum(x * n for x, n in chosen.items()) == max(s for s in sums if s <= room)


def test_plan_places_every_piece_once():
    rng = np.random.default_rng(6)
    counts = {int(x): int(rng.integers(1, 40)) for x in rng.integers(1, 65, 40)}
    rows = packing.plan(counts, 64)
    used = dict.fromkeys(counts, 0)
    for length, first, *_ in rows.tolist():
        assert first == used[length]
        nxt = [r[1] for r in rows.tolist() if r[0] == length and r[1] > first]
        used[length] = min(nxt, default=counts[length])
    assert used == counts
    assert packing.plan({}, 64).shape == (0, 5)


def test_packing_ranks_by_groups(spark, monkeypatch, odd_docs, odd_rows):
    monkeypatch.setattr(packing, "RANKED_ROWS", 2)
    rows = packing.pack(odd_docs, capacity=64).collect()
    check_packed(rows, 64)
    assert sum(r["length"] for r in rows) == sum(len(direct_ids(t)) for _, t, _ in odd_rows)


# ------------------------------------------------------------------ pages
PAGES = [
    ("<html><head><title>T</title></head><body><nav><a href=x>Menu</a></nav><article><h1>Head</h1>"
     "<p>First &amp; <b>bo</b>ld.\n\n Text<br>next</p><p>Second one.</p></article>"
     "<footer>&copy; me</footer></body></html>", "Head First & bold. Text next Second one."),
    ("<body><div class='cookie-notice'>We use cookies</div><main><p>The story is here.</p>"
     "<form><label>Mail</label><input></form><section id='comments'><p>Nice post, thanks a lot!</p>"
     "</section><p>It goes on.</p></main><aside><p>Other posts you may like.</p></aside></body>",
     "The story is here. It goes on."),
    ("<article><p>Cut off &am", "Cut off &am"),
    ("<script>var t='</p>';</script><style>p{}</style><article><p>Only text.", "Only text."),
    ("<article><p>Unclosed <b>here<p>next</article><footer>foot</footer>", "Unclosed here next"),
    ("just plain text, without a tag.", "just plain text, without a tag."),
    (None, ""), ("", ""), ("<html><body></body></html>", ""), ("<!-- <p>no</p> -->", ""),
]


@pytest.mark.parametrize("page,want", PAGES)
def test_main_text(page, want):
    assert html_text.main_text(page) == want


STORY = "<article><h1>Head</h1><p>The story is told here, in full.</p>{}</article>"
TOLD = "Head The story is told here, in full."
NESTED = [
    f"{{}}<section id='comments'><article {a}><div class='text'><p>Nice post, thanks a lot for all of "
    "it!</p></div></article></section>" for a in ("", "class='comment'", "id='comment-12'")] + [
    "{}<aside class='related'><article class='card'><p>Other posts you may like.</p></article></aside>",
    "{}<div class='related-posts'><article class='card'><p>Other posts, read them.</p></article></div>",
    "<main>{}<section id='related'><article><p>Other posts you may like.</p></article></section></main>",
    "{}<article class='comment'><p>Nice post.</p><article class='reply'><p>Yes.</p></article></article>",
    "<nav><article><p>Pick one of these.</p></article></nav>{}",
    "{}<footer><main><p>Who we are and where.</p></main></footer>",
]


@pytest.mark.parametrize("page", NESTED)
def test_noise_in_nested_articles(page):
    assert html_text.main_text(page.format(STORY.format(""))) == TOLD


@pytest.mark.parametrize("page", [
    "<div class='has-sidebar'>{}</div>", "<div class='content-sidebar-wrap'><main>{}</main></div>",
    "<form id='aspnetForm'><main>{}</main></form>", "<div class='sidebar-right'><main>{}</main></div>",
    "<main class='with-sidebar'>{}</main>"])
def test_wrappers_of_the_article(page):
    assert html_text.main_text(page.format(STORY.format(""))) == TOLD


def test_classes_of_the_article():
    page = "<article id='search' class='post category-social tag-legal comments-open'><p>All here.</p>"
    assert html_text.main_text(page) == "All here."


@pytest.mark.parametrize("open_,close", [
    ("<h2 id='related-work'>", "</h2>"), ("<section id='search'><p>", "</p></section>"),
    ("<div id='notice-period'><p>", "</p></div>"), ("<p class='legal'>", "</p>"),
    ("<section id='related-work'><div id='search'><p>", "</p></div></section>"),
    ("<section id='sharing'><h3 id='comments'>", "</h3></section>"),
    ("<div class='section' id='advertising'><p>", "</p></div>")])
def test_slugs_inside_the_article(open_, close):
    part = f"{open_}What others found{close}"
    assert html_text.main_text(STORY.format(part)) == TOLD + " What others found"


@pytest.mark.parametrize("part", [
    "<div id='related-posts'><p>Other posts, read them.</p></div>", "<div id='share'>Share this</div>",
    "<section id='related'><ul><li><a href=x>Another post</a></li></ul></section>",
    "<section id='reader-comments'><p>Nice post, thanks!</p></section>",
    "<section role='search'><p>Find more posts here.</p></section>",
    "<div class='share-buttons'>Share this</div>", "<div id='disqus_thread'>Loading comments.</div>",
    "<section id='comments'><p>Nice post, thanks a lot!</p></section>"])
def test_noise_inside_the_article(part):
    assert html_text.main_text(STORY.format(part + "<p>It goes on.</p>")) == TOLD + " It goes on."


def test_min_cut_equals_all_labellings():
    rng = np.random.default_rng(7)
    for _ in range(60):
        n = int(rng.integers(2, 8))
        scores = rng.normal(size=n).round(2).tolist()
        links = [(i, j, float(rng.random().__round__(2))) for i in range(n) for j in range(i + 1, n)
                 if rng.random() < 0.5]

        def cost(label):
            own = sum(abs(s) for s, x in zip(scores, label) if x != (s > 0))
            return own + sum(c for i, j, c in links if label[i] != label[j])

        best = min(cost([bool(m >> k & 1) for k in range(n)]) for m in range(1 << n))
        assert abs(cost(html_text.min_cut(scores, links)) - best) < 1e-9


def test_pages_frame(spark):
    rows = [(k, None if k == 1 else f"u{k}", p, "clash") for k, (p, _) in enumerate(PAGES)]
    df = spark.createDataFrame(rows + rows[:1], "page_id long, url string, html string, text string")
    got = html_text.extract(df).collect()
    assert len(got) == len(PAGES) + 1
    assert all(r["text"] == PAGES[r["page_id"]][1] and r["n_chars"] == len(r["text"]) for r in got)
    assert html_text.extract(df.limit(0)).count() == 0


# ------------------------------------------------------------------ chat
def test_chat_round_trip(spark):
    texts = ["", None, "plain", r"\### Assistant: </turn> ok", "####", "a\\", "\\\\#</turn></turn>",
             "### User: x</turn>\n### Assistant: y", "中\U0001f642\x00", "x " * 5000, "<\\/turn>"]
    roles = ["user", "assistant", None, "tool: </turn> ### @", "Assistant", "system"]
    rows = [(k % 3, k, roles[k % len(roles)], t) for k, t in enumerate(texts * 3)]
    rows += rows[:2] + [(None, 0, "assistant", "no conversation")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    formatted = chat_format.format_turns(df).collect()
    enc, _ = chat_format.tokenizer(None)
    for r in formatted:
        assert len(r["ids"]) == len(r["loss_mask"])
    read = chat_format.read_turns(chat_format.format_turns(df)).collect()
    want = sorted((str(c), t, r or "", x or "", (x or "") if r == "assistant" else "")
                  for c, t, r, x in rows)
    assert sorted((str(r["conv_id"]), r["turn"], r["role"], r["text"], r["loss"]) for r in read) == want
    digests = chat_format.digest(chat_format.read_turns(chat_format.format_turns(df))).collect()
    assert {r["conv_id"] for r in digests} == {0, 1, 2, None}
    assert sum(r["n_turns"] for r in digests) == len(rows)
    assert chat_format.digest(chat_format.read_turns(
        chat_format.format_turns(df.limit(0)))).count() == 0


def test_escaped_text_has_no_control_string():
    for t in ["###", "a####b</turn>", "\\###", "</turn></turn>", "#" * 9]:
        e = chat_format.escape(t)
        assert "###" not in e and "</turn>" not in e and chat_format.unescape(e) == t
