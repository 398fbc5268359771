"""Edge cases of the corpus operators, and brute force where SQL cannot say the same."""

import gzip
import hashlib
import random
import time
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from lendspark.llm import (
    chosen_path,
    grace,
    language_id,
    line_quality,
    main_text,
    packing,
    queries,
    repeats,
    shingles,
    token_counts,
    tokens,
    warc,
)
from lendspark.llm.common import stored
from lendspark.llm.components import components
from lendspark.llm.files import open_folder
from lendspark.llm.mixing import Mix, leaf_budgets, mix_sources
from lendspark.llm.tokens import Tokenizer as Fast
from lendspark.session import scratch_path
from tests.conftest import SMALL

VOCABULARY = str(public_tokenizers.path("word_bpe_49k.json"))
# Column names that operators use themselves.
CLASHES = ["_near_id", "_all", "_left", "_gone", "a.b", "kept", "n_words", "group_size", "k1", "node", "_host", "tokens", "row", "epoch", "set_id"]
SCHEMA = "doc_id BIGINT, text STRING, lang STRING, source STRING, n_chars BIGINT"
LONG = "lorem ipsum dolor " * 4000
ODD = [
    (1, None, "en", "src1", None),
    (2, "", None, "src1", 0),
    (3, "word", "en", None, 4),
    (3, "word", "en", None, 4),
    (None, "some words, again and again", "de", "src2", 5),
    (5, " \t\n\x0b", "de", "", 3),
    (6, LONG, "fr", "src2", 9),
    (7, LONG, "fr", "src2", 9),
    (8, "12 !! ??", "fr", "src2", 9),
    (9, "Ünïcödé ß 漢字 🙂", "de", "src2", 9),
]


def odd_documents(spark):
    df = spark.createDataFrame(ODD, SCHEMA)
    return df.withColumns({name: F.lit("x") for name in CLASHES})


def documents(spark, rows):
    return spark.createDataFrame(
        [(i, t, "en", "src0", len(t or "")) for i, t in rows], SCHEMA
    )


OPERATORS = {
    "near": lambda df: chosen_path.near_groups(df),
    "tokens": lambda df: token_counts.count_tokens(df, VOCABULARY, token_counts.Layout(49407)),
    "language": lambda df: language_id.predict(df),
    "mix": lambda df: mix_sources(df, queries.source_levels(), Mix()),
    "repeats": lambda df: repeats.remove_repeats(df),
    "quality": lambda df: line_quality.with_verdict(df),
    "exact": lambda df: grace.groups(df),
    "pack": lambda df: packing.pack(df, packing.Packing(VOCABULARY)),
}


@pytest.mark.parametrize("name", OPERATORS)
def test_odd_rows_and_clashing_names(spark, name):
    rows = OPERATORS[name](odd_documents(spark)).collect()
    expected = len(ODD)
    if name == "pack":
        rows = [r for r in rows if r["piece"] == 0]
    if name == "mix":
        expected = len(rows)
        assert rows
    assert len(rows) == expected


@pytest.mark.parametrize("name", OPERATORS)
def test_empty_tables(spark, name):
    assert OPERATORS[name](spark.createDataFrame([], SCHEMA)).count() == 0


@pytest.mark.parametrize("stage", [s for s in corpus_pipeline.STAGES], ids=lambda s: s[0])
def test_stages_keep_the_columns_and_take_odd_rows(spark, stage):
    name, function = stage
    for df in (odd_documents(spark), odd_documents(spark).limit(0)):
        out = function(spark, df, SMALL)
        out.collect()
        if name != corpus_pipeline.STAGES[-1][0]:
            assert out.columns == df.columns


def test_pages_with_nothing_in_them(spark):
    pages = spark.createDataFrame(
        [(1, None, None), (2, "http://a b\n/ü", ""), (2, "u", "<p>" + "x" * 200), (None, "u", "<p>" + "x" * 200)],
        "page_id BIGINT, url STRING, html STRING",
    ).withColumn("text", F.lit(1))
    assert [r["text"] for r in main_text.extract(pages).orderBy("n_chars").collect()][:2] == ["", ""]
    rows = warc.round_trip(pages).collect()
    assert sorted(r["payload_bytes"] for r in rows) == [0, 0, 203, 203]
    assert {r["record_type"] for r in rows} == {"response", "revisit"} or len(rows) == 4
    assert main_text.extract(pages.limit(0)).count() == 0 and warc.round_trip(pages.limit(0)).count() == 0


# --- archives -------------------------------------------------------------------


def test_archive_reads_only_what_is_chosen(spark):
    pages = spark.createDataFrame(
        [(i, f"http://h/{i}", "same payload " * 20 if i % 3 == 0 else f"page {i} " * 30) for i in range(60)],
        "page_id BIGINT, url STRING, html STRING",
    )
    folder = scratch_path(spark, "warc-test")
    index = warc.write_archive(pages, folder)
    chosen = index.where("page_id IN (3, 4, 40, 41)")
    rows = {r["page_id"]: r for r in warc.read_records(chosen, folder).collect()}
    assert set(rows) == {3, 4, 40, 41}
    assert (rows[3]["record_type"], rows[3]["refers_to"], rows[3]["payload"]) == ("revisit", 0, None)
    assert bytes(rows[4]["payload"]).decode() == "page 4 " * 30
    # Every range is a compressed member of its own.
    system, root = open_folder(folder)
    for r in index.collect():
        with system.open_input_file(f"{root}/{r['file']}") as file:
            assert gzip.decompress(file.read_at(r["length"], r["offset"])).endswith(b"\r\n\r\n")


def test_ranges_are_fetched_together():
    ranges = [(0, 10), (10, 10), (25, 5), (1000, 10)]
    assert list(warc.spans(ranges, 5, 100)) == [ranges[:3], ranges[3:]]
    assert list(warc.spans(ranges[:3], 5, 20)) == [ranges[:2], ranges[2:3]]


# --- near duplicates ------------------------------------------------------------


def brute_components(sets):
    names = {i: i for i in sets}

    def find(i):
        while names[i] != i:
            i = names[i]
        return i

    ids = sorted(sets)
    for k, a in enumerate(ids):
        for b in ids[k + 1 :]:
            both = len(sets[a] & sets[b])
            if sets[a] and 100 * both >= 80 * len(sets[a] | sets[b]):
                x, y = find(a), find(b)
                names[max(x, y)] = min(x, y)
    return {i: find(i) for i in ids}


@pytest.mark.parametrize("settings", [chosen_path.Join(words=2), chosen_path.Join(words=2, node_size=8, node_pairs=16, max_depth=1)])
def test_groups_of_near_copies_against_brute_force(spark, settings):
    random.seed(4)
    words = [f"w{i}" for i in range(400)]
    rows = []
    for family in range(4):
        base = random.choices(words, k=90)
        for _ in range(30):
            copy = list(base)
            for _ in range(random.randint(0, 9)):
                copy[random.randrange(len(copy))] = random.choice(words)
            rows.append(" ".join(copy))
    rows += [" ".join(random.choices(words, k=60)) for _ in range(40)]
    df = documents(spark, enumerate(rows))
    sets = {}
    for i, text in enumerate(rows):
        w = text.split()
        sets[i] = set(zip(w, w[1:]))
    found = {r["doc_id"]: r["component_id"] for r in chosen_path.near_groups(df, settings=settings).collect()}
    assert found == brute_components(sets)


def test_classes_stay_where_they_lie_and_texts_move_to_their_readers(spark):
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df, settings = queries.table(spark, SMALL, "documents"), chosen_path.Join(words=2)
        found = chosen_path.similar(df, settings=settings)
        members = stored(found.classes.select(F.xxhash64("set_id").alias("node"), "set_id", F.lit(1).cast("bigint").alias("label")), "members")
        compared = chosen_path.undecided(members, found.classes, settings)
        checked = chosen_path.confirmed(found.links, found.classes, df, "text", "doc_id", settings)
        for moved in (compared, checked):
            plan = moved._jdf.queryExecution().executedPlan().toString()
            # The members, or those who read a text, but neither classes nor texts.
            assert plan.count("hashpartitioning(set_id") == 1
        assert checked.count() == found.links.distinct().count()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)


def test_components_of_a_long_chain_and_a_star(spark):
    chain = [(str(i).encode(), str(i + 1).encode()) for i in range(60)]
    star = [(b"hub", f"s{i}".encode()) for i in range(40)]
    links = spark.createDataFrame(chain + star, "a BINARY, b BINARY")
    roots = {bytes(r["id"]): bytes(r["root"]) for r in components(links).collect()}
    assert len(roots) == 61 + 41 and len(set(roots.values())) == 2


# --- memory of workers -----------------------------------------------------------


def test_workers_hand_back_what_large_tasks_freed(spark):
    psutil = pytest.importorskip("psutil")

    def held():
        """MB of the largest Python worker."""
        of = [p for p in psutil.Process().children(recursive=True) if "pyspark.daemon" in p.cmdline()]
        return max((p.memory_full_info().uss for p in of), default=0) / 1e6

    text = F.concat_ws(" ", *[F.sha2(F.concat(F.col("id"), F.lit(f"/{k}")), 512) for k in range(16)])
    few, many = (spark.range(n).coalesce(1).select(F.col("id").alias("doc_id"), text.alias("text")) for n in (10, 24_000))
    assert grace.keep_one(few).count() == 10
    before = held()
    assert grace.keep_one(many).count() == 24_000
    assert held() < before + 60


# --- tokens ---------------------------------------------------------------------


def test_word_lookup_equals_the_tokenizer():
    texts = [
        "İstanbul ΣΑΣ 'S don't we'll a1b2 ½ ²x", "<|endoftext|> hi", "", "é é ﬁ", "a\x1cb\x85c\xa0d",
        "O'SE '' 's 'sabc -'s !'t", "µ ª º × ÷ ß ÿ ǅ ǆ", LONG,
    ]
    plain = Tokenizer.from_file(VOCABULARY)
    wanted = [np.asarray(plain.encode(t, add_special_tokens=False).ids, "<u4").tobytes() for t in texts]
    assert Fast(VOCABULARY).encode(texts) == wanted


@pytest.mark.parametrize("block", [16, 1000, 4 << 20])
def test_token_counts_over_blocks(spark, block):
    texts = ["", "one", None, "two words here <|endoftext|> still text", "x " * 500, ""]
    df = documents(spark, enumerate(texts)).repartition(2)
    counts = token_counts.count_tokens(df, VOCABULARY, token_counts.Layout(49407, block=block))
    plain = Tokenizer.from_file(VOCABULARY)
    plain.encode_special_tokens = True
    wanted = {i: len(plain.encode(t or "", add_special_tokens=False).ids) for i, t in enumerate(texts)}
    assert {r["doc_id"]: r["n_tokens"] for r in counts.collect()} == wanted


def test_a_document_without_its_end(spark):
    folder = scratch_path(spark, "open-end")
    system, root = open_folder(folder)
    system.create_dir(root, recursive=True)
    data = np.array([5, 9, 7, 9, 9, 1, 2, 3], "<u2").tobytes()
    with system.open_output_stream(f"{root}/f", compression=None) as file:
        file.write(data)
    files = spark.createDataFrame([("f", len(data)), ("none", 0)], "file STRING, bytes BIGINT")
    rows = token_counts.scan(files, folder, token_counts.Layout(9, block=6)).orderBy("ordinal").collect()
    assert [(r["ordinal"], r["n_tokens"]) for r in rows] == [(0, 1), (1, 1), (2, 0), (3, 3)]


def test_packing_of_all_small_documents(spark):
    rows = queries.QUERIES["op10_best_fit_packing"](spark, SMALL).collect()
    plain = Tokenizer.from_file(VOCABULARY)
    wanted, total = {}, 0
    for r in queries.table(spark, SMALL, "documents").collect():
        ids = plain.encode(r["text"] or "", add_special_tokens=False).ids + [0]
        total += len(ids)
        for k, at in enumerate(range(0, len(ids), 2048)):
            piece = np.asarray(ids[at : at + 2048], "<u4")
            wanted[r["doc_id"], k] = (at, len(piece), zlib.crc32(piece.tobytes()))
    assert {(r["doc_id"], r["piece"]): (r["start"], r["length"], r["ids_crc32"]) for r in rows} == wanted
    bins = defaultdict(list)
    for r in rows:
        bins[r["sequence_id"]].append((r["offset"], r["length"]))
    for pieces in bins.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at <= 2048
    assert len(bins) <= 1.1 * total / 2048 + 1


def test_the_fullest_bin_closes_first():
    bins = packing.OpenBins(10, 2, 0)
    assert [bins.place(n) for n in (6, 7, 8)] == [(0, 0), (1, 0), (2, 0)]
    # Bin 2, with two places left, is closed; what would have fitted there goes to bin 1.
    assert bins.place(2) == (1, 7)
    assert bins.place(4) == (0, 6)


# --- exact copies ---------------------------------------------------------------


def test_spilling_gives_the_same_groups():
    random.seed(1)
    texts = [f"text {random.randrange(300)} " * 20 for _ in range(2000)]
    rows = [[hash(t) & (2**64 - 1) if i else 7, t, 1, i] for i, t in enumerate(texts)]
    rows = [[int.from_bytes(hashlib.blake2b(t.encode(), digest_size=8).digest(), "big"), t, 1, i] for _, t, _, i in rows]
    for memory in (5_000, 10**9):
        found = list(grace.distinct([list(r) for r in rows], memory))
        assert {r[1]: r[2] for r in found} == Counter(texts)
        last = {t: i for i, t in enumerate(texts)}
        assert {r[1]: r[3] for r in found} == last


def test_equal_hashes_are_not_equal_texts():
    found = list(grace.distinct([[5, "a", 1, 1], [5, "b", 1, 2], [5, "a", 1, 3]], 10**9))
    assert sorted((r[1], r[2], r[3]) for r in found) == [("a", 2, 3), ("b", 1, 2)]
    assert len(list(grace.distinct([[5, str(i), 1, i] for i in range(50)], 100))) == 50


def test_one_of_repeated_rows_stays(spark):
    rows = grace.groups(documents(spark, [(1, "a"), (1, "a"), (1, "a"), (2, None), (0, "")])).collect()
    assert Counter((r["doc_id"], r["kept"]) for r in rows) == {(1, True): 1, (1, False): 2, (2, True): 1, (0, False): 1}
    assert grace.keep_one(documents(spark, [(1, "a"), (1, "a"), (2, None)])).count() == 2


# --- repeated strings -----------------------------------------------------------


def brute_repeats(texts, length, keep_first):
    seen, places = Counter(), {}
    for i in sorted(texts):
        for k in range(len(texts[i]) - length + 1):
            window = texts[i][k : k + length]
            seen[window] += 1
            places.setdefault(window, (i, k))
    kept = {}
    for i, t in texts.items():
        covered = bytearray(len(t))
        for k in range(len(t) - length + 1):
            window = t[k : k + length]
            if seen[window] > 1 and not (keep_first and places[window] == (i, k)):
                covered[k : k + length] = b"\1" * length
        kept[i] = bytes(b for b, c in zip(t, covered) if not c)
    return kept


@pytest.mark.parametrize("keep_first", [True, False])
@pytest.mark.parametrize("surroundings", [20_000, 1])
def test_repeats_against_brute_force(spark, keep_first, surroundings):
    random.seed(9)
    noise = lambda n: "".join(random.choices("abcd éß\n", k=n))
    shared = [noise(n) for n in (39, 40, 41, 90, 300)]
    texts = {}
    for i in range(40):
        parts = [noise(random.randint(0, 60))]
        for _ in range(random.randint(0, 3)):
            parts += [random.choice(shared), noise(random.randint(0, 60))]
        texts[i] = "".join(parts).encode()
    texts[40], texts[41] = texts[3], ("ab" * 200).encode()
    df = documents(spark, [(i, t.decode()) for i, t in texts.items()])
    settings = repeats.Repeats(length=40, gram=12, surroundings=surroundings)
    found = repeats.remove_repeats(df, settings=settings, keep_first=keep_first).collect()
    assert {r["doc_id"]: bytes(r["kept"]) for r in found} == brute_repeats(texts, 40, keep_first)
    assert all(r["n_bytes"] - r["n_removed"] == len(r["kept"]) for r in found)


def test_suffix_ranks_order_and_equality():
    random.seed(2)
    data = np.array([random.randint(1, 3) for _ in range(200)] + [0])
    for length in (1, 5, 7, 20, 33):
        rank = repeats.suffix_classes(data, length)
        texts = [tuple(data[i : i + length]) + (0,) * length for i in range(len(data))]
        cut = [t[:length] for t in texts]
        for _ in range(500):
            i, j = random.randrange(200), random.randrange(200)
            assert (rank[i] < rank[j]) == (cut[i] < cut[j]) and (rank[i] == rank[j]) == (cut[i] == cut[j])


def test_long_texts_are_worked_on_in_pieces():
    settings = repeats.Repeats(length=40, gram=12)
    random.seed(3)
    text = bytes(random.choices(range(97, 101), k=3 * repeats.CHUNK_BYTES // 2))
    _, first, last, _, _ = repeats._text_runs(text, settings)
    covered = sorted(zip(first.tolist(), last.tolist()))
    assert covered[0][0] == 0 and covered[-1][1] == len(text) - 40
    assert all(b[0] == a[1] + 1 for a, b in zip(covered, covered[1:]))


# --- language, main text, mixing, quality -----------------------------------------


def test_held_out_accuracy(spark):
    truth = queries.table(spark, "/root/testdata/sf0.01", "documents").select("doc_id", "lang")
    found = queries.QUERIES["op4_language_id"](spark, "/root/testdata/sf0.01").join(truth, "doc_id")
    right = F.avg((F.col("lang") == F.col("lang_pred")).cast("int"))
    assert found.where("held_out").agg(right).first()[0] > 0.98
    assert found.where("score < 0 OR score > 1").count() == 0


def test_texts_without_letters_have_no_language(spark):
    df = spark.createDataFrame(
        [(1, "the cat sat on the mat", "en"), (4, "le chat est sur la table", "fr"), (5, "12 !!", "en"), (6, None, "fr")],
        "doc_id BIGINT, text STRING, lang STRING",
    )
    found = {r["doc_id"]: (r["lang_pred"], r["score"]) for r in language_id.predict(df).collect()}
    assert found[5] == found[6] == ("und", 0.0)


def test_no_language_is_too_many_or_too_rare(spark):
    random.seed(6)
    rows = []
    for k in range(140):
        words = ["".join(random.choices("abcdefghijklmnopqrstuvwxyz", k=6)) for _ in range(30)]
        # Ids of which one is learned from in the last language, and more in the first ones.
        ids = range(1000 * k, 1000 * k + (8 if k < 70 else 5))
        texts = {i: " ".join(random.sample(words, 25)) for i in ids if k < 139 or zlib.crc32(str(i).encode()) % 4 == 2}
        if k == 139:
            one = next(i for i in range(1000 * k + 50, 1000 * k + 100) if zlib.crc32(str(i).encode()) % 4 != 2)
            texts[one] = " ".join(words)
        rows += [(i, text, f"l{k}") for i, text in texts.items()]
    df = spark.createDataFrame(rows, "doc_id BIGINT, text STRING, lang STRING")
    right = {i: lang for i, _, lang in rows}
    learned = {lang for i, _, lang in rows if zlib.crc32(str(i).encode()) % 4 != 2}
    found = {r["doc_id"]: r["lang_pred"] for r in language_id.predict(df).collect()}
    assert len(learned) == 140
    assert {i for i in found if found[i] != right[i]} == set()


PAGE = """<!DOCTYPE html><html><head><title>No</title><style>p{x:1}</style></head><body>
<nav><ul><li><a href=/>Home</a></li></ul></nav><div id="cookie-notice"><p>We use cookies, always.</p></div>
<div class=ad>Buy &amp; be happy.</div><article><h1>Title</h1><p>First &lt;b&gt; <b>bold</b>
 text, with commas.<br><p>Second &eacute;, short.<ul><li>Item</li></ul></article>
<section class="comments"><p>I disagree, with many words, and commas, and so on.</p></section>
<form><input><p>Search here, now.</p></form><aside><p>Side, bar.</p></aside><footer>&copy; me</footer>"""


def test_main_text_of_a_page_with_everything():
    blocks = main_text.content_blocks(PAGE, main_text.Ratios())
    assert blocks == ["Title", "First <b> bold text, with commas.", "Second é, short.", "Item"]


def test_words_of_names_do_not_take_text_out_of_an_article():
    long = "A long sentence, with commas, that goes on for a while. " * 4
    page = f"""<body><div class="ad">Buy this.</div><article><h1 id="search">Search</h1><p>{long}</p>
    <h2 id="related-work">Related work</h2><section id="social-history"><p>{long}</p></section>
    <div id="search-algorithms"><p>{long}</p></div><p>{long} An <span class="alert">alert</span> inside.</p>
    <section id="comments"><p>{long}</p></section><div class="share">Share it</div></article></body>"""
    kept = main_text.content_blocks(page, main_text.Ratios())
    text = long.strip()
    assert kept == ["Search", text, "Related work", text, text, f"{text} An alert inside."]


LONG_COMMENT = "I do not agree, with many words, and commas. And so on, and so forth, without an end. " * 6
ARTICLE = "<h1>Title</h1><p>{0}</p><p>{0}</p><ul><li>Item</li></ul>".format("A sentence, with commas, that goes on. " * 9)
WANTED = ["Title", *["A sentence, with commas, that goes on. " * 9] * 2, "Item"]


@pytest.mark.parametrize(
    "page",
    [
        "<body><article>{a}<div class='comments'><p>{c}</p><p>{c}</p></div></article></body>",
        "<body><article>{a}</article><section id=comments><article class=comment><p>{c}</p></article></section></body>",
        "<body><main>{a}<div class=ad>{c}</div></main></body>",
        "<body><div class=sidebar><p>{c}</p></div><div class=post>{a}</div></body>",
        "<body><div class='cookie-notice'><p>{c}</p></div><article>{a}</article></body>",
        "<body><form action=/><header><p>Site</p></header><div class=post>{a}</div></form></body>",
        "<body><article>{a}<form class=x><p>{c}</p><p>short</p></form><p hidden>{c}</p></article></body>",
        "<body><div class=post>{a}</div><div style='color:red; display: none'><p>{c}</p></div></body>",
        "<body><article>{a}<div role=complementary><p>{c}</p></div><aside><p>{c}</p></aside></article></body>",
        "<body><div class='site-sidebar-wrapper'><main>{a}</main><p>{c}</p></div></body>",
        "<body><div id=content>{a}<ol class='comment-list'><li>{c}</li><li>{c}</li></ol></div></body>",
        "<body><article>{a}</article><div class='newsletter signup'><p>{c}</p></div><footer><p>{c}</p></footer></body>",
    ],
)
def test_comments_adverts_and_the_like_go_whatever_they_hold(page):
    html = page.format(a=ARTICLE, c=LONG_COMMENT)
    assert main_text.content_blocks(html, main_text.Ratios()) == [t.strip() for t in WANTED]


def test_attributes_are_read_as_such():
    long = "A long sentence, with commas, that goes on for a while. " * 4
    page = f"""<article><header><h1>Title</h1></header><p title="a hidden gem">{long}</p>
    <p data-role="search">{long}</p><p data-hidden="no" class="x">{long}</p><p hidden="">{long}</p></article>"""
    assert main_text.content_blocks(page, main_text.Ratios()) == ["Title", *[long.strip()] * 3]


def test_a_page_that_is_all_hinted_is_left_to_the_ratios():
    long = "A long sentence, with commas, that goes on for a while. " * 4
    page = f"<div class=sidebar><p>{long}</p><a>x</a></div>"
    assert long.strip() in main_text.content_blocks(page, main_text.Ratios())


def test_lines_of_a_long_text_are_looked_up_in_linear_time(spark):
    letters = lambda k: "".join(chr(97 + (k // 26**i) % 26) for i in range(4))
    menu = "\n".join(f"menu {letters(i)}" for i in range(10_000))
    own = "\n".join(f"own words about {letters(i)} and more" for i in range(10_000))
    rows = [(1, f"{own}\n{menu}")] + [(2 + i, f"{menu}\n{letters(i)} alone") for i in range(25)]
    clashes = ["_all", "_left", "_host", "_gone", "_k1", "_words", "_lines", "kept", "a.b"]
    df = documents(spark, rows).withColumns({name: F.lit("x") for name in clashes})
    judged = line_quality._judged(line_quality._renamed(df), "_in_text", "_in_source", line_quality.Limits())
    started = time.time()
    (row,) = line_quality._without_frequent(judged.where("_in_doc_id = 1"), "_in_text").collect()
    assert row["_in_text"] == own and time.time() - started < 30
    assert line_quality.keep_good(df).columns == df.columns
    verdict = line_quality.with_verdict(df)
    assert set(clashes) <= set(verdict.columns) and verdict.where("doc_id = 1").first()["a.b"] == "x"


def test_reading_tasks_follow_the_bytes(spark):
    folder = scratch_path(spark, "many-blocks")
    df = documents(spark, [(i, "some words " * 50) for i in range(64)]).repartition(2)
    layout = token_counts.Layout(49407, block=64, blocks_a_task=4)
    manifest = token_counts.write_tokens(df, folder, VOCABULARY, layout, "text", "doc_id")
    files = manifest.where(F.col("ordinal") == token_counts.TOTAL).select("file", "bytes")
    tasks = []
    keep = token_counts.stored
    token_counts.stored = lambda frame, name: tasks.append(frame.rdd.getNumPartitions()) or keep(frame, name)
    try:
        token_counts.scan(files, folder, layout)
    finally:
        token_counts.stored = keep
    total = files.agg(F.sum("bytes")).first()[0]
    assert tasks[0] >= total // 64 // 4
    pages = spark.createDataFrame([(i, "u", f"page {i} " * 300) for i in range(40)], "page_id BIGINT, url STRING, html STRING")
    small = warc.Archive(share=200)
    index = warc.write_archive(pages, scratch_path(spark, "warc-tasks"), small)
    size = index.agg(F.sum("length")).first()[0]
    assert warc.read_records(index, "/nowhere", small).rdd.getNumPartitions() >= size // 200
    with pytest.raises(ValueError, match="70000"):
        tokens.narrow(np.array([70_000], "<u4").tobytes(), 2)


def test_a_teaser_in_an_article_element_is_not_the_page():
    long = "A long sentence, with commas, that goes on for a while. " * 8
    post = f"<div class=post><p>{long}</p><p>{long}</p></div>"
    teaser = "<div class=cards><article><h3>Other</h3><p>Read on, soon.</p></article></div>"
    for page in (post + teaser, teaser + post):
        assert main_text.content_blocks(page, main_text.Ratios()) == [long.strip()] * 2


def test_short_blocks_beside_the_paragraphs_stay():
    long = "A long sentence, with commas, that goes on for a while. " * 10
    text = long.strip()
    kept = lambda page: main_text.content_blocks(page, main_text.Ratios())
    rest = "<ul><li>Item</li></ul><table><tr><td>Cell</td></tr></table><blockquote class=pull>Quote</blockquote>"
    page = f"<article><h1>Title</h1><div class=body><p>{long}</p><p>{long}</p></div>{rest}</article>"
    whole = ["Title", text, text, "Item", "Cell", "Quote"]
    assert kept(f"<body>{page}</body>") == kept(page) == whole
    assert kept(f"<body><main><h1>Title</h1><article>{page[23:]}</main></body>") == whole
    for start in ("<html><body>", "<html class=a><body class=x>", "<body id=y>", ""):
        flat = f"{start}<h1>Title</h1><p>{long}</p><p>{long}</p>{rest}<div class=links><a>Home</a></div>"
        assert kept(flat) == whole
        parts = f"{start}<div class=post><h1>Title</h1><div class=a><p>{long}</p></div><div class=b><p>{long}</p></div>{rest}</div>"
        assert kept(parts + "<div class=links><a>Home</a></div>") == whole
    teaser = f"<article><p>{long[:200]}</p></article>"
    post = f"<div class=post><h1>Title</h1><p>{long}</p><p>{long}</p>{rest}</div>"
    assert [one for one in kept(post + teaser) if one != text[:199].strip()][:6] == whole
    quoted = f"<div class=post><blockquote><p>{long}</p></blockquote><p>Mine.</p></div><div class=x>Home</div>"
    assert kept(quoted) == [text, "Mine."]


def test_main_text_by_ratios_alone():
    page = "<div class=c><h2>Head</h2><p>Long text, with things. And more of it.</p></div><div class=x><a>a</a><a>b</a></div>"
    assert main_text.content_blocks(page, main_text.Ratios()) == ["Head", "Long text, with things. And more of it."]
    for broken in ("<", "a < b", "<p", '<a title="x>y</a> z', "<!-- open", "<script>x", "</p></div>", "&#xfffffff;"):
        main_text.content_blocks(broken, main_text.Ratios())


def test_shortages_go_to_siblings_first(spark):
    leaves = spark.createDataFrame(
        [("a", "x", 10), ("a", "y", 100), ("b", "x", 100), ("b", "y", 100)],
        "_level0 STRING, _level1 STRING, tokens BIGINT",
    )
    mix = Mix(share=0.5, max_epochs=1)
    got = {(r["_level0"], r["_level1"]): r["budget"] for r in leaf_budgets(leaves, 2, mix).collect()}
    # 155 tokens: 77.5 each; the lack of a/x is made up for by a/y alone.
    assert got == {("a", "x"): 10.0, ("a", "y"): 67.5, ("b", "x"): 38.75, ("b", "y"): 38.75}
    mix = Mix(weights={("a",): 9.0}, share=0.5, max_epochs=1)
    got = {(r["_level0"], r["_level1"]): r["budget"] for r in leaf_budgets(leaves, 2, mix).collect()}
    # a can give 110 of its 139.5; the rest comes from b.
    assert got == {("a", "x"): 10.0, ("a", "y"): 100.0, ("b", "x"): 22.5, ("b", "y"): 22.5}


def test_epochs_and_prefixes_meet_the_budget(spark):
    rows = [(i, "w " * (1 + i % 7), "en" if i % 4 else "de", "s1") for i in range(400)]
    df = spark.createDataFrame(rows, "doc_id BIGINT, text STRING, lang STRING, source STRING")
    mix = Mix(weights={("en",): 1.0, ("de",): 1.0}, max_epochs=4)
    out = mix_sources(df, [F.col("lang"), F.col("source")], mix).persist()
    sizes = {i: 1 + i % 7 for i in range(400)}
    used = defaultdict(int)
    epochs = defaultdict(set)
    for r in out.collect():
        used[r["row"]["lang"]] += sizes[r["row"]["doc_id"]]
        epochs[r["row"]["lang"], r["epoch"]].add(r["row"]["doc_id"])
    half = sum(sizes.values()) / 2
    assert all(half - 7 <= n <= half for n in used.values())
    german = {i for i in range(400) if i % 4 == 0}
    assert epochs["de", 0] == german and epochs["de", 1] <= german
    assert ("de", 3) not in epochs and 0 < len(epochs["en", 0]) < 300
    # The same again: choices follow from the seed.
    again = mix_sources(df.repartition(5), [F.col("lang"), F.col("source")], mix)
    key = lambda frame: sorted((r["row"]["doc_id"], r["epoch"], r["order"]) for r in frame.collect())
    assert key(out) == key(again)


def test_lines_of_many_documents_deplete_those_made_of_them(spark):
    line = "menu of the site with some words in it that are always the same on all of its pages and longer"
    random.seed(5)
    own = lambda: " ".join("".join(random.choices("abcdefghij", k=8)) for _ in range(60))
    rows = [(i, f"{line}\nand {own()}") for i in range(100)]
    rows += [(1000 + i, f"{line}\nonly {i} few words") for i in range(5)]
    kept = {r["doc_id"]: r["kept"] for r in line_quality.with_verdict(documents(spark, rows)).collect()}
    assert all(kept[i] for i in range(100)) and not any(kept[1000 + i] for i in range(5))


def test_frequent_lines_are_taken_out_of_what_is_kept(spark):
    random.seed(5)
    own = [" ".join("".join(random.choices("abcdefghij", k=8)) for _ in range(60)) for _ in range(50)]
    rows = [(i, f"Menu  of {i} pages\n{own[i]}\n\n menu of {9 - i % 10} Pages\nEnd of {own[i][:9]}") for i in range(40)]
    rows += [(i, own[i]) for i in range(40, 50)]
    wanted = {i: f"{own[i]}\n\nEnd of {own[i][:9]}" if i < 40 else own[i] for i in range(50)}
    found = {r["doc_id"]: r["text"] for r in line_quality.keep_good(documents(spark, rows)).collect()}
    assert found == wanted
    # A bound that does not grow with the host.
    bounded = line_quality.Limits(line_share=0.9, most_documents=30)
    free = line_quality.Limits(line_share=0.9)
    size = lambda limits: sum(len(r["text"]) for r in line_quality.keep_good(documents(spark, rows), limits=limits).collect())
    assert size(bounded) < size(free)


def test_copies_do_not_make_a_line_frequent(spark):
    text = " ".join(f"w{k}" for k in range(50))
    rows = line_quality.with_verdict(documents(spark, [(i, text) for i in range(200)])).collect()
    assert all(r["kept"] for r in rows)


def five_words(text):
    """The set that the stage compares: five words each, or all of a shorter text."""
    words = text.lower().split()
    return set(zip(*[words[k:] for k in range(5)])) or ({tuple(words)} if words else set())


def test_pipeline_against_its_stages_done_by_hand(spark):
    packed = corpus_pipeline.run(spark, SMALL)
    left = {r["doc_id"] for r in packed.select("doc_id").distinct().collect()}
    docs = {r["doc_id"]: r["text"] for r in queries.table(spark, SMALL, "documents").collect()}
    good = {r["doc_id"] for r in queries.QUERIES["op8_quality_rules"](spark, SMALL).where("kept").collect()}
    assert left <= good
    assert len({docs[i] for i in left}) == len(left)
    sets = {i: five_words(docs[i]) for i in left}
    assert len(set(brute_components(sets).values())) == len(left)
    assert packed.where("length > 2048").count() == 0


def test_every_stage_of_the_pipeline_keeps_exactly_what_it_should(spark):
    stages, ids, rows = dict(corpus_pipeline.STAGES), {}, {}
    df = queries.table(spark, SMALL, "documents")
    for name in ("quality_rules", "exact_dedup", "near_dedup", "mixing"):
        df = stored(stages[name](spark, df, SMALL), "stage")
        rows[name] = df.collect()
        ids[name] = sorted(r["doc_id"] for r in rows[name])
    good = queries.QUERIES["op8_quality_rules"](spark, SMALL).where("kept").collect()
    assert ids["quality_rules"] == sorted(r["doc_id"] for r in good)
    last = {r["text"]: r["doc_id"] for r in sorted(rows["quality_rules"], key=lambda r: r["doc_id"])}
    assert ids["exact_dedup"] == sorted(last.values())
    words = {r["doc_id"]: r["text"].lower().split() for r in rows["exact_dedup"]}
    groups = brute_components({r["doc_id"]: five_words(r["text"]) for r in rows["exact_dedup"]})
    assert ids["near_dedup"] == sorted(set(groups.values()))
    # Budgets give up no token, and each leaf meets its own but for the document at its end.
    sizes = {i: len(words[i]) for i in ids["near_dedup"]}
    held = defaultdict(list)
    for r in rows["near_dedup"]:
        held[r["lang"], r["source"]].append(sizes[r["doc_id"]])
    supply = [("src", *leaf, sum(n)) for leaf, n in held.items()]
    leaves = spark.createDataFrame(supply, "_level0 STRING, _level1 STRING, _level2 STRING, tokens BIGINT")
    used = Counter()
    for r in rows["mixing"]:
        used[r["lang"], r["source"]] += sizes[r["doc_id"]]
    budgets = leaf_budgets(leaves, 3, corpus_pipeline.MIX).collect()
    assert sum(r["budget"] for r in budgets) == pytest.approx(sum(sizes.values()))
    for r in budgets:
        leaf = r["_level1"], r["_level2"]
        assert r["budget"] - max(held[leaf]) < used[leaf] + 1e-6 and used[leaf] <= r["budget"] + 1e-6
    assert set(ids["mixing"]) <= set(ids["near_dedup"])


def test_sets_of_very_different_sizes_are_not_compared(monkeypatch):
    """Nor is the result another than by definition, at and around the threshold."""
    draw = np.random.default_rng(8)
    words = draw.integers(0, 60, 4000).astype(np.uint64)
    sets = [shingles.shingle_set(words[a : a + n], 2) for a, n in draw.integers(1, 400, (60, 2))]
    for one in sets:
        assert (one == np.unique(one)).all()
        odd, shift = shingles._multipliers(192)
        least = [min(((int(x) >> 32 ^ int(s)) * int(o)) % 2**32 for x in one) for o, s in zip(odd.ravel()[:3], shift.ravel()[:3])]
        assert shingles.minwise(one, 192)[:3].tolist() == least
    settings = chosen_path.Join(words=2)
    pairs = [(one, two) for one in sets for two in sets]
    pairs += [(one, one[: round(len(one) * share)]) for one in sets for share in (0.79, 0.8, 0.81)]
    by_definition = lambda a, b: 100 * len(set(a) & set(b)) >= 80 * len(set(a) | set(b))
    assert all(chosen_path._similar(a, b, settings) == by_definition(a.tolist(), b.tolist()) for a, b in pairs)
    monkeypatch.setattr(np, "concatenate", None)
    assert not chosen_path._similar(np.arange(7, dtype=np.uint64), np.arange(10, dtype=np.uint64), settings)
