"""The training-data operators against brute force, exact round trips and held-out accuracy; odd rows in every operator."""

import hashlib
import re
import zlib
from collections import Counter, defaultdict
from itertools import combinations

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

import corpus_pipeline
from boardlens.llm import chat, decontam, html_extract, langid, lmscore, packing, quality, queries, rules, similar, simhash, textstats, token_files
from boardlens.llm.common import read_table

SF = "/root/testdata/sf0.001"
DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"
PROSE = " ".join(f"word{i % 97} and{i}" for i in range(120))
ODD = [
    (1, None, None, None, None), (2, "", "en", "a", 0), (3, " \n\t", "en", "a", 3), (4, "one two", "en", None, 7), (4, "one two", "en", None, 7),
    (None, "no id here", "en", "a", 9), (5, PROSE, "en", "a", 1), (6, PROSE, "en", "a", 1), (7, PROSE + " end", "en", "a", 1), (8, "x " * 40000, "de", "a", 1),
]


@pytest.fixture(scope="module")
def docs(spark):
    return {r.doc_id: r.text for r in read_table(spark, SF, "documents").collect()}


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame(ODD, DOCS).withColumns({"label": F.lit("clash"), "key": F.lit(1), "stats": F.lit(2), "component": F.lit(3)})


def encoded(texts, end):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(queries.tokenizer_path())
    return [np.array([*t.encode(x or "", add_special_tokens=False).ids, end], "<u4") for x in texts]


def test_html_keeps_the_article():
    page = (
        "<html><head><title>T</title><script>var a = '<p>no</p>';</script></head><body><nav><a href='/'>Home</a></nav>"
        "<div class='article'><h1>A title of the page</h1><p>First &amp; long\n  paragraph with <b>bold</b> words in it, long enough to count.</p>"
        "<p>Second paragraph, which is also long enough to count as text.</p></div>"
        "<div id='comments'><p>A reader says something at great length about the article here.</p></div><footer>Copyright</footer></body></html>"
    )
    assert html_extract.main_text(page).split("\n\n") == [
        "A title of the page", "First & long paragraph with bold words in it, long enough to count.", "Second paragraph, which is also long enough to count as text."
    ]
    assert html_extract.main_text(None) == html_extract.main_text("") == html_extract.main_text("<nav>x</nav>") == ""


def test_html_keeps_links_and_short_lines_of_the_article():
    long = "A paragraph that is long enough to count as text of the page, whatever stands around it."
    page = (
        f"<html><body><nav><a href='/'>Home</a></nav><main><article><h1><a href='/x'>A linked headline</a></h1><p>{long}</p>"
        f"<aside><p>One</p><p>Two</p><p>Three</p><p>Four</p></aside><p>The end.</p><p><a href='/y'>{long}</a></p></article></main><p><a href='/z'>{long} Menu</a></p></body></html>"
    )
    assert html_extract.main_text(page).split("\n\n") == ["A linked headline", long, "The end.", long]


def test_isotonic_is_monotone_and_keeps_the_mean():
    mean, weight = np.array([0.2, 0.1, 0.5, 0.4, 0.9]), np.array([1.0, 3, 2, 2, 1])
    out = quality.isotonic(mean, weight)
    assert (np.diff(out) >= 0).all() and np.isclose((out * weight).sum(), (mean * weight).sum())


def test_quality_held_out(spark):
    d = "/root/testdata/sf0.01"
    out = queries.op2_quality_classifier(spark, d).join(read_table(spark, d, "labels"), "doc_id").toPandas()
    held = out[out.held_out]
    assert (held.predicted == held.quality).mean() > 0.93 and out.score.between(0, 1).all()
    assert ((out.score >= 0.7) == (out.predicted == 1)).all()


def base_of(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    seen = Counter(tuple(words[i : i + 8]) for i in range(len(words) - 7))
    inside = {j for i in range(len(words) - 7) if seen[tuple(words[i : i + 8])] > 1 for j in range(i, i + 8)}
    lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return [len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), len(inside)]


def test_rule_statistics(spark, docs):
    for r in queries.op4_quality_rules(spark, SF).collect():
        base = base_of(docs[r.doc_id])
        assert [r[n] for n in textstats.BASE] == base
        assert r.base_failed == (base[0] < 20 or 100 * base[4] > 30 * base[0]) and not (r.base_failed and r.kept)


def test_rules_learn_from_few_labels(spark):
    d = "/root/testdata/sf0.01"
    out = queries.op4_quality_rules(spark, d).join(read_table(spark, d, "labels"), "doc_id").toPandas()
    held = out[[zlib.crc32(str(x).encode()) % 4 == 2 for x in out.doc_id]]
    assert held[held.quality == 0].kept.mean() <= 0.15 and held[held.quality == 1].kept.mean() >= 0.9


def test_rules_find_a_planted_threshold(spark):
    texts = [(i, " ".join(f"w{i}x{j}" + ("!" if i % 3 == 0 else "") for j in range(30))) for i in range(600)]
    rows = spark.createDataFrame(texts, "doc_id bigint, text string")
    stats = rows.select("doc_id", textstats.text_statistics(F.col("text")).alias("stats"))
    found = rules.learn_rules(stats, spark.createDataFrame([(i, int(i % 3 != 0)) for i, _ in texts], "doc_id bigint, quality int"))
    assert found and all(r.kept == (r.doc_id % 3 != 0) for r in stats.select("doc_id", rules.verdict(found).alias("kept")).collect())


def test_packing_is_gapless_and_whole(spark, docs):
    ids = dict(zip(docs, encoded(docs.values(), 2), strict=True))
    rows = queries.op3_packing(spark, SF).collect()
    places = defaultdict(list)
    for r in rows:
        piece = ids[r.doc_id][r.start : r.start + r.length]
        assert r.doc_tokens == len(ids[r.doc_id]) and r.ids_crc32 == zlib.crc32(piece.tobytes())
        places[r.sequence_id].append((r.offset, r.length))
    assert sum(r.length for r in rows) == sum(map(len, ids.values()))
    for parts in places.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= packing.MAX_TOKENS
    assert len(places) <= -(-sum(map(len, ids.values())) // packing.MAX_TOKENS) * 1.05 + 1


def test_texts_meet_the_tokenizer_once(spark):
    plan = packing.token_pieces(read_table(spark, SF, "documents"), queries.tokenizer_path())._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ArrowEvalPython") == 1


@pytest.mark.parametrize("values", [[0], [0] * 500, [1, 2, 3] * 99, [2**29] * 7, [2**30, 5, 2**31, 0] * 40, list(range(40000))])
def test_simple8b_round_trip(values):
    ids = np.array(values, np.uint64)
    segment = token_files.Segment(token_files.encode_segment([7], [ids]))
    assert (segment.ids() == ids).all() and (segment.ids(1, 30) == ids[1:30]).all()


def test_token_files(spark, docs):
    start = 0
    rows = {r.doc_id: r for r in queries.op5_token_files(spark, SF).collect()}
    for doc, ids in sorted(zip(docs, encoded(docs.values(), 1), strict=True)):
        assert tuple(rows[doc]) == (doc, start, len(ids), zlib.crc32(ids.tobytes()))
        start += len(ids)


def plain_tiles(text, item, least):
    """Greedy string tiling by comparing every pair of places again for each tile."""
    a, b, marked_a, marked_b, covered = text.split(), item.split(), set(), set(), 0
    while True:
        best = (least - 1, 0, 0)
        for i in range(len(a)):
            for j in range(len(b)):
                n = 0
                while i + n < len(a) and j + n < len(b) and a[i + n] == b[j + n] and i + n not in marked_a and j + n not in marked_b:
                    n += 1
                best = max(best, (n, -i, -j))
        n, i, j = best[0], -best[1], -best[2]
        if n < least:
            return covered
        marked_a |= set(range(i, i + n))
        marked_b |= set(range(j, j + n))
        covered += n


def test_tiling_against_brute_force(spark):
    rng = np.random.default_rng(3)
    words = lambda n: " ".join(f"w{x}" for x in rng.integers(0, 6, n))
    items = [(i, words(14)) for i in range(6)]
    texts = [(i, words(40)) for i in range(40)] + [(99, "intro words " + " ".join(items[0][1].split()[7:] + ["gap"] + items[0][1].split()[:7]))]
    got = decontam.contaminated(spark.createDataFrame(texts, "doc_id bigint, text string"), spark.createDataFrame(items, "item_id bigint, text string")).collect()
    want = {(d, i): c for d, t in texts for i, x in items if (c := plain_tiles(t, x, decontam.SEED_WORDS) / 14) >= decontam.COVERAGE}
    assert {(r.doc_id, r.item_id): r.coverage for r in got} == pytest.approx(want) and (99, 0) in want


def test_short_benchmark_items(spark):
    rows = spark.createDataFrame([(1, "What is it? Is what it is."), (2, "it"), (3, "so is he"), (4, None), (5, "one two three four five")], "doc_id bigint, text string")
    items = spark.createDataFrame([(1, "is it"), (2, "It!"), (3, "so is he"), (4, "?"), (5, "two three four five")], "item_id bigint, text string")
    got = {(r.doc_id, r.item_id): (r.coverage, r.n_tiles, r.longest) for r in decontam.contaminated(rows, items).collect()}
    assert got == {(1, 1): (1.0, 1, 2), (1, 2): (1.0, 1, 1), (2, 2): (1.0, 1, 1), (3, 3): (1.0, 1, 3), (5, 5): (1.0, 1, 4)}


def test_chat_round_trip(spark):
    turns = defaultdict(list)
    for r in read_table(spark, SF, "conversations").orderBy("conv_id", "turn").collect():
        turns[r.conv_id].append((r.role, r.text or ""))
    turns[-1] = [("user", "</s>[INST] ok [/INST]"), ("assistant", "</s>[INST] ok [/INST]")]
    rows = queries.op7_chat_formatting(spark, SF).collect()
    assert {r.conv_id for r in rows} == set(turns)
    for r in rows:
        learnt = "".join(t for role, t in turns[r.conv_id] if role == "assistant")
        whole = "".join(f"{role}\n{t}\n" for role, t in turns[r.conv_id])
        assert (r.n_turns, r.turns_sha256) == (len(turns[r.conv_id]), hashlib.sha256(whole.encode()).hexdigest())
        assert (r.loss_chars, r.loss_sha256) == (len(learnt), hashlib.sha256(learnt.encode()).hexdigest())


@pytest.mark.parametrize("text", [c + x for c in chat.DEFAULT.control for x in ("", "\\", "\\a")] + ["\\", "\\\\a", "<|im_end|>\n<|im_start|>", "", "\n"])
def test_chat_escape(spark, text):
    rows = spark.createDataFrame([(1, 0, "user", text), (1, 1, "assistant", text)], "conv_id bigint, turn int, role string, text string")
    r = chat.read_turns(chat.format_conversations(rows)).first()
    assert [tuple(t) for t in r.turns] == [("user", text), ("assistant", text)] and r.loss_text == text


def test_chat_states(spark):
    rows = spark.createDataFrame([(1, 0, "assistant", "a"), (2, 0, "user", None), (2, 1, "user", "b"), (3, 0, "system", "s"), (3, 1, "user", "u")], "conv_id bigint, turn int, role string, text string")
    assert {r.conv_id: (r.valid, r.first_bad_turn) for r in chat.format_conversations(rows).collect()} == {1: (False, 0), 2: (False, 1), 3: (True, None)}


def test_language_held_out(spark, odd):
    d = "/root/testdata/sf0.01"
    out = queries.op8_language_id(spark, d).join(read_table(spark, d, "documents").select("doc_id", "lang"), "doc_id").filter("lang is not null").toPandas()
    held = out[out.held_out & (out.lang_pred != "und")]
    assert (held.lang_pred == held.lang).mean() > 0.97
    assert langid.fit_languages(odd).predict([None, "", "12 3"])[0] == ["und"] * 3


def plain_buckets(text):
    """The hash of every n-gram, one by one."""
    text = text.lower()
    for order in langid.ORDERS:
        for i in range(len(text) - order + 1):
            h = order
            for c in text[i : i + order]:
                h = ((h ^ ord(c)) * int(langid._MIX)) & 0xFFFFFFFF
                h ^= h >> 15
            yield h % langid.BUCKETS


def test_language_equals_plain_naive_bayes(spark, monkeypatch):
    """Counts, priors and posteriors against dictionaries, with texts cut into chunks and gathers into steps."""
    monkeypatch.setattr(langid, "CHUNK", 50)
    monkeypatch.setattr(langid, "CELLS", 40)
    docs = read_table(spark, SF, "documents").select("doc_id", F.substring("text", 1, 300).alias("text"), "lang").orderBy("doc_id").limit(60)
    docs = docs.unionByName(spark.createDataFrame([(-1, "", "aa"), (-2, "x\ud55c\U0001F600 y", "aa"), (-3, None, "bb"), (-4, "z", None), (5, "repeated", "en")], docs.schema))
    docs = docs.unionByName(docs.filter("doc_id = 5"))
    rows = docs.collect()
    learnt = [r for r in rows if r.text is not None and r.lang is not None and zlib.crc32(str(r.doc_id).encode()) % 4 != 2]
    names = sorted({r.lang for r in learnt})
    counts = {name: Counter() for name in names}
    for r in learnt:
        counts[r.lang].update(plain_buckets(r.text))
    model = langid.fit_languages(docs)
    assert model.languages == names
    for r in rows:
        if not r.text or not any(map(str.isalpha, r.text)):
            assert model.predict([r.text])[0] == ["und"]
            continue
        joint = []
        for name in names:
            total = sum(counts[name].values()) + langid.SMOOTHING * langid.BUCKETS
            prior = sum(x.lang == name for x in learnt) / len(learnt)
            joint.append(np.log(prior) + sum(np.log((counts[name][b] + langid.SMOOTHING) / total) for b in plain_buckets(r.text)))
        joint = np.array(joint)
        got = model.log_joint([r.text, "other", r.text])
        assert np.allclose(got[[0, 2]], joint, rtol=1e-5)
        name, score = model.predict([None, r.text])
        assert name[1] == names[joint.argmax()] and abs(score[1] - 1 / np.exp(joint - joint.max()).sum()) < 1e-3


def test_lm_scores_prefer_the_target(spark):
    rows = spark.createDataFrame([(i, f"a b c d e{i % 3}" if i % 2 else f"k l m n o{i % 3}", bool(i % 2)) for i in range(60)] + [(99, None, None)], "doc_id bigint, text string, good boolean")
    model = lmscore.fit_difference(rows, "good")
    out = rows.select("doc_id", "good", lmscore.score_udf(spark, model)("text").alias("s")).select("doc_id", "good", "s.*").collect()
    assert all(r.n_words == 0 and r.score == 0 for r in out if r.doc_id == 99)
    assert max(r.score for r in out if r.good) < min(r.score for r in out if r.good is False)


def plain_lm_scores(rows):
    """{id: (background loss, target loss)} by dictionaries of words and word pairs, for (id, text, good)."""
    words, pairs = [Counter(), Counter()], [Counter(), Counter()]
    split = {i: (text or "").lower().split() for i, text, _ in rows}
    for i, _, good in rows:
        for side in (0, 1) if good else (0,):
            words[side].update(split[i])
            pairs[side].update(zip(split[i], split[i][1:]))
    vocabulary = {w for w, n in words[0].items() if n >= lmscore.MIN_COUNT}
    totals = [sum(x.values()) for x in words]
    if not totals[1]:
        words[1], pairs[1], totals[1] = words[0], pairs[0], totals[0]

    def loss(side, before, word):
        scale = totals[1] / totals[side]
        mass = words[side][word] if word in vocabulary else totals[side] - sum(words[side][w] for w in vocabulary)
        single = (mass * scale + lmscore.SMOOTHING) / (totals[1] + lmscore.SMOOTHING * (len(vocabulary) + 1))
        context = words[side][before] if before in vocabulary else 0
        return -np.log(lmscore.SHARE * pairs[side][before, word] / context + (1 - lmscore.SHARE) * single if context else single)

    return {i: tuple(np.mean([loss(side, b, w) for b, w in zip([None, *x], x)]) if x else 0.0 for side in (0, 1)) for i, x in split.items()}


def test_lm_scores_keep_pairs_met_once(spark):
    rows = [(1, "a b c d a c", True), (2, "b a d c b d", False), (3, "c c a", None), (4, "", True)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, good boolean")
    out = df.select("doc_id", lmscore.score_udf(spark, lmscore.fit_difference(df, "good"))("text").alias("s")).collect()
    want = plain_lm_scores(rows)
    for r in out:
        assert np.allclose((r.s.loss_background, r.s.loss_target), want[r.doc_id], rtol=1e-4)


def test_lm_scores_share_no_counts(spark, monkeypatch):
    rng = np.random.default_rng(3)
    rows = [(i, " ".join(f"w{x}" for x in rng.zipf(1.3, 400) % 5000), i % 3 == 0) for i in range(40)]
    rows += [(50, " ".join(f"once{i}" for i in range(20000)), True), (51, None, None), (None, "w1 w2", None), (52, "w1 w2", False), (52, "w1 w2", False)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, good boolean")
    want = plain_lm_scores([(k, *x[1:]) for k, x in enumerate(rows)])
    expected = sorted((-1 if i is None else i, *want[k][::-1]) for k, (i, _, _) in enumerate(rows))
    for words, bucket in ((lmscore.CHUNK_WORDS, lmscore.BUCKET_WORDS), (1000, 3000)):
        monkeypatch.setattr(lmscore, "CHUNK_WORDS", words)
        monkeypatch.setattr(lmscore, "BUCKET_WORDS", bucket)
        got = sorted((-1 if r.doc_id is None else r.doc_id, r.loss_target, r.loss_background) for r in lmscore.scores(df, "good").collect())
        assert len(got) == len(rows) and np.allclose(got, expected)
    udf = df.select(lmscore.score_udf(spark, lmscore.fit_difference(df, "good"))("text").alias("s")).filter("s.n_words = 20000").first().s
    assert np.allclose((udf.loss_background, udf.loss_target), want[40])
    assert lmscore.scores(df.filter("false"), "good").count() == 0
    none = lmscore.scores(df.withColumn("good", F.lit(None).cast("boolean")), "good").collect()
    assert len(none) == len(rows) and all(r.score == 0 for r in none)


def plain_print(text):
    words = [x.translate({c: c + 32 for c in range(65, 91)}) for x in re.findall(r"[^\x20\x09-\x0D]+", text or "")]
    shingles = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def roots(ids, links):
    parent = {x: x for x in ids}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        parent[max(root(a), root(b))] = min(root(a), root(b))
    return {x: root(x) for x in ids}


def test_simhash_against_brute_force(spark, docs):
    prints = {d: plain_print(t) for d, t in docs.items()}
    want = roots(prints, [(a, b) for a, b in combinations(prints, 2) if (prints[a] ^ prints[b]).bit_count() <= 2])
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in queries.op10_simhash_near_dedup(spark, SF).collect()}
    assert got == {d: (f"{prints[d]:016x}", want[d]) for d in prints}


def test_crowded_tiles_lose_no_link(spark, monkeypatch):
    monkeypatch.setattr(simhash, "TILE", 16)
    rng = np.random.default_rng(5)
    fps = [int(x) for x in {0, *(sum(1 << int(b) for b in rng.choice(20, rng.integers(1, 6), replace=False)) for _ in range(400))}]
    links = simhash.fingerprint_links(spark.createDataFrame([(x,) for x in fps], "fp bigint")).collect()
    near = [(a, b) for a, b in combinations(fps, 2) if (a ^ b).bit_count() <= 2]
    assert roots(fps, [(r.a, r.b) for r in links]) == roots(fps, near) and {frozenset((r.a, r.b)) for r in links}


def test_similar_groups_against_brute_force(spark, docs):
    sets = {d: set(simhash.shingle_hashes(t, 5).tolist()) for d, t in docs.items()}
    near = [(a, b) for a, b in combinations(sets, 2) if docs[a] == docs[b] or sets[a] and sets[b] and len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b])]
    kept = {r.doc_id for r in similar.distinct_documents(read_table(spark, SF, "documents")).collect()}
    assert kept == set(roots(sets, near).values())


def test_similar_groups_with_added_passages(spark):
    rng = np.random.default_rng(11)
    rows, near = [], []
    for k in range(400):
        shingles = [50, 100, 200][k % 3]
        added = round(shingles * rng.uniform(0.17, 0.25))
        body = [f"w{x}" for x in rng.integers(0, 4000, shingles + 4)]
        extra = [f"w{x}" for x in rng.integers(0, 4000, added)]
        rows += [(2 * k, " ".join(body)), (2 * k + 1, " ".join(extra + body if k % 2 else body + extra))]
    rows += [(5000 + k, " ".join(rows[0][1].split() + [f"tail{k}"])) for k in range(60)]
    sets = {i: set(simhash.shingle_hashes(x, 5).tolist()) for i, x in rows}
    prints = {i: simhash.fingerprint(np.unique(simhash.shingle_hashes(x, 2))) for i, x in rows}
    near = [(a, b) for a, b in combinations(sets, 2) if len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b])]
    assert any((prints[a] ^ prints[b]).bit_count() > similar.RADIUS for a, b in near)
    got = {r.doc_id for r in similar.distinct_documents(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()}
    assert got == set(roots(sets, near).values())


def joined_rows(spark, run):
    """What ``run`` returns, and the rows that all joins of its jobs made."""
    store = spark._jsparkSession.sharedState().statusStore()
    known = store.executionsCount()
    out = run()
    spark._jsparkSession.sparkContext().listenerBus().waitUntilEmpty()
    made, listed = 0, store.executionsList()
    for i in range(known, listed.size()):
        at = listed.apply(i).executionId()
        nodes, values = store.planGraph(at).allNodes(), store.executionMetrics(at)
        for node in (nodes.apply(k) for k in range(nodes.size())):
            ids = [m.accumulatorId() for m in (node.metrics().apply(k) for k in range(node.metrics().size())) if m.name() == "number of output rows"]
            made += sum(int(values.apply(x).replace(",", "")) for x in ids if "Join" in node.name() and values.contains(x))
    return out, made


def test_edited_copies_do_not_all_meet(spark):
    """Copies of a text with so many edits that few are similar to each other: all share its shingles, candidates stay few."""
    rng = np.random.default_rng(23)
    base = [f"w{x}" for x in rng.integers(0, 4000, 150)]
    rows = []
    for k in range(600):
        words = list(base)
        for at in rng.integers(0, 150, 1 + k % 12):
            words[at] = f"e{rng.integers(0, 10**9)}"
        rows.append((k, " ".join(words)))
    sets = {i: set(simhash.shingle_hashes(x, 5).tolist()) for i, x in rows}
    near = [(a, b) for a, b in combinations(sets, 2) if len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b])]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").coalesce(1)
    kept, made = joined_rows(spark, lambda: {r.doc_id for r in similar.distinct_documents(docs).collect()})
    assert kept == set(roots(sets, near).values())
    assert made < 60 * len(rows)


def test_odd_rows(spark, odd, tmp_path):
    benchmark = spark.createDataFrame([(1, "one two three four five"), (2, None), (3, "")], "item_id bigint, text string")
    assert quality.with_statistics(odd).count() == len(ODD)
    assert simhash.near_duplicates(odd).count() == len(ODD)
    assert {r.doc_id for r in simhash.near_duplicates(odd).filter("component_id = 1").collect()} == {1, 2, 3}
    assert decontam.contaminated(odd, benchmark).count() == 0
    packed = packing.pack(packing.token_pieces(odd, queries.tokenizer_path()))
    assert packed.filter("start = 0").count() == len(ODD)
    assert packing.sequences(packed).select(F.sum("length")).first()[0] == packed.select(F.sum("length")).first()[0]
    token_files.write_token_files(odd, str(tmp_path / "t"), queries.tokenizer_path())
    back = token_files.read_token_files(spark, str(tmp_path / "t")).orderBy("start").collect()
    assert [r.doc_id for r in back] == [None, 1, 2, 3, 4, 4, 5, 6, 7, 8]


@pytest.mark.parametrize("empty", [False, True])
def test_learning_without_rows(spark, empty):
    """No labels, one class only, or no documents: defined results."""
    docs = spark.createDataFrame([] if empty else [(i, f"some words {i} " * 9, "en") for i in range(40)], "doc_id bigint, text string, lang string")
    stats = docs.select("doc_id", textstats.text_statistics(F.col("text")).alias("stats"))
    one_class = spark.createDataFrame([(i, 1) for i in range(40)], "doc_id bigint, quality int")
    for labels in (one_class, one_class.filter("false")):
        assert rules.learn_rules(stats, labels) == []
        model = quality.fit_quality(quality.with_statistics(docs), labels)
        scores = [r.s for r in quality.with_statistics(docs).select(quality.score_udf(model)("stats").alias("s")).collect()]
        assert len(scores) == docs.count() and all(0 <= s <= 1 for s in scores)
    predicted = docs.select(langid.predict_udf(langid.fit_languages(docs))("text").alias("p")).select("p.*").collect()
    assert {r.lang_pred for r in predicted} <= {"en"} and len(predicted) == docs.count()


def test_html_through_spark(spark):
    rows = [(1, None, None), (2, "u", ""), (3, "u", "<p>" + "long text " * 60000 + "</p>"), (4, "u", "<article><p>Hi.</p></article>"), (4, "u", "<article><p>Hi.</p></article>"), (None, "u", "<nav>x</nav>")]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string").withColumn("text", F.lit("clash"))
    got = pages.select("page_id", F.coalesce(html_extract.extract(F.col("html")), F.lit("")).alias("t")).collect()
    assert sorted((r.page_id or 0, len(r.t)) for r in got) == [(0, 0), (1, 0), (2, 0), (3, 599999), (4, 3), (4, 3)]
    assert pages.filter("false").select(html_extract.extract(F.col("html"))).collect() == []


@pytest.mark.parametrize("empty", [False, True])
def test_stages_on_odd_rows(spark, odd, empty):
    rows = odd.filter("false") if empty else odd
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, rows, SF)
        kept = out.collect()
        assert name == "packing" or out.columns == rows.columns
        assert not (empty and kept)
        if name == "near_dedup" and not empty:
            assert sorted(r.doc_id or 0 for r in kept) == [0, 1, 3, 4, 5, 8]
