"""Round trips of token archives against the tokenizer itself."""

import zlib
from hashlib import sha256

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from lendspark.llm import queries, token_archive, tokens
from lendspark.llm.files import open_folder
from lendspark.llm.tokens import Tokenizer as Fast
from lendspark.session import scratch_path
from tests.conftest import SMALL

VOCABULARY = str(public_tokenizers.path("byte_bpe_50k.json"))
SCHEMA = "doc_id BIGINT, text STRING"
PLAIN = Tokenizer.from_file(VOCABULARY)
ODD_TEXTS = [
    "", "a  b", " a", "a ", "\n a b", "x y z 　 w", "<|endoftext|> a <|endoftext|>b c<|endoftext|>",
    "don't 's it's 12 34a\tb \r\n c", "é ü ᠎ q ​ r", "a \x1c b", "日本 語 a", "́ a ́b", "a \xad b",
    "!  ? . ..  \n\n x", "I'll we 'll O'SE", "a" * 3000 + " " * 40 + "b\n" * 50,
]


def ids_of(text):
    return np.asarray([*PLAIN.encode(text or "", add_special_tokens=False).ids, 0], "<u4")


def wanted(rows):
    """``(doc_id, start, n_tokens, crc)`` of rows in order."""
    found, at = [], 0
    for doc_id, text in rows:
        ids = ids_of(text)
        found.append((doc_id, at, len(ids), zlib.crc32(ids.tobytes())))
        at += len(ids)
    return found


def test_stretches_equal_the_tokenizer():
    fast = Fast(VOCABULARY)
    assert fast.stretches
    expected = [np.asarray(PLAIN.encode(t, add_special_tokens=False).ids, "<u4").tobytes() for t in ODD_TEXTS]
    assert fast.encode(ODD_TEXTS) == expected == fast.encode(ODD_TEXTS)


def test_all_small_documents(spark):
    rows = queries.QUERIES["op13_token_archive"](spark, SMALL).collect()
    docs = sorted((r["doc_id"], r["text"]) for r in queries.table(spark, SMALL, "documents").collect())
    assert sorted((r["doc_id"], r["start"], r["n_tokens"], r["ids_crc32"]) for r in rows) == wanted(docs)


def test_odd_rows_clashing_names_and_small_files(spark):
    rows = [*enumerate(ODD_TEXTS), (50, None), (51, "word " * 30_000), (52, "tie"), (52, "tie")]
    df = spark.createDataFrame(rows, SCHEMA).withColumns({c: F.lit("c") for c in ("content", "tie", "part", "ids", "file")})
    settings = token_archive.Archive(VOCABULARY, file_bytes=1000, read_bytes=500)
    found = token_archive.round_trip(df.repartition(4), settings).collect()
    assert sorted((r["doc_id"], r["start"], r["n_tokens"], zlib.crc32(r["ids"])) for r in found) == wanted(rows)
    nobody = token_archive.round_trip(spark.createDataFrame([(None, "b"), (1, "a")], SCHEMA), settings).orderBy("start").collect()
    assert [r["doc_id"] for r in nobody] == [None, 1]
    assert token_archive.round_trip(spark.createDataFrame([], SCHEMA), settings).count() == 0


def text_of(i):
    return f"document {i} speaks of this and that, " + "and what all the others say of it as well, " * 4 + f"but for {i * i}"


def written(spark, n=300):
    df = spark.createDataFrame([(i, text_of(i)) for i in range(n)], SCHEMA)
    settings = token_archive.Archive(VOCABULARY)
    folder = scratch_path(spark, "archive-test")
    dictionary = token_archive.train_dictionary(df, settings)
    return token_archive.write(df, folder, settings, dictionary), folder, dictionary


def test_one_document_is_read_alone(spark):
    files, folder, dictionary = written(spark)
    rows = files.orderBy("part").collect()
    assert sum(r["documents"] for r in rows) == 300 and len(rows) > 1
    second = rows[1]["file"]
    first = rows[0]["documents"]
    ids = token_archive.read_document(folder, second, dictionary, 3)
    assert ids.tolist() == ids_of(text_of(first + 3)).tolist()


def test_the_dictionary_is_shared_named_and_needed(spark):
    files, folder, dictionary = written(spark)
    assert len(dictionary) > 256
    assert token_archive.load_dictionary(folder, sha256(dictionary).hexdigest()) == dictionary
    name = files.first()["file"]
    with pytest.raises(ValueError, match="another dictionary"):
        token_archive.read_document(folder, name, b"other", 0)
    file, index, width = token_archive.open_archive(folder, name, dictionary)
    file.close()
    # With the dictionary a frame takes far less than its ids.
    assert index["length"].sum() < index["n_ids"].sum() * width / 2


def test_ids_that_do_not_fit_are_refused():
    with pytest.raises(ValueError, match="70000"):
        tokens.narrow(np.array([1, 70_000], "<u4").tobytes(), 2)
    assert tokens.narrow(np.array([1, 70_000], "<u4").tobytes(), 4)


def test_files_are_in_order_and_self_contained(spark):
    files, folder, dictionary = written(spark, 1200)
    system, root = open_folder(folder)
    last = -1
    for r in files.orderBy("part").collect():
        file, index, _ = token_archive.open_archive(folder, r["file"], dictionary)
        file.close()
        assert index["doc_id"].tolist() == sorted(index["doc_id"]) and index["doc_id"][0] > last
        last = index["doc_id"][-1]
        assert (len(index), int(index["n_ids"].sum())) == (r["documents"], r["ids"])
        assert system.get_file_info(f"{root}/{r['file']}").size == r["bytes"]


def test_usual_stretches_are_merged_without_the_file():
    """Only the beginnings of texts, marks and unusual characters go through the whole tokenizer."""
    import numpy as np
    import public_tokenizers
    from lendspark.llm.tokens import Tokenizer

    file = Tokenizer(str(public_tokenizers.path("byte_bpe_50k.json")))
    sent, packed = [], file._packed
    file._packed = lambda texts: sent.extend(texts) or packed(texts)
    texts = ["The W\u00f6rter, it's so.\nNext 12%%% x,y &&& \u00fcnd---\n\n End<|", "", "one 3rd's  two\t'll\n"]
    found = [np.frombuffer(ids, "<u4").tolist() for ids in file.encode(texts)]
    assert found == [file.file.encode(text, add_special_tokens=False).ids for text in texts]
    assert not any(" " in part for part in sent if part not in texts)
    odd = ["see \u4e2d\u6587 it", "so <|endoftext|>x it"]
    found = [np.frombuffer(ids, "<u4").tolist() for ids in file.encode(odd)]
    assert found == [file.file.encode(text, add_special_tokens=False).ids for text in odd]


def test_words_at_line_ends_and_starts_are_known_by_themselves():
    fast = Fast(VOCABULARY)
    texts = ["So it is.\nThe end, and\nso on.\n12 of\n\xc9t\xe9 \"a\"", "is.\nThe on\nso", "\nThe \nis", "a\n\nb is.\nThe", "a \tb\t c"]
    expected = [np.asarray(PLAIN.encode(t, add_special_tokens=False).ids, "<u4").tobytes() for t in texts]
    assert fast.encode(texts) == expected == fast.encode(texts)
    assert {"is.", "\nThe", "on.", "\n12"} <= set(fast.known)
    assert not any("\n" in stretch[1:] or stretch[-1:].isspace() for stretch in fast.known)


def test_any_white_space_between_any_characters():
    draw = np.random.default_rng(13)
    parts = [" ", " ", " ", "\n", "\n", "\t", "\r", "\xa0", "\xad", " ", "a", "The", "\xe9t\xe9", "7", "'s", "'", ",", ".", "<|endoftext|>", "日", "́", "\x00", "\U0001f600"]
    texts = ["".join(draw.choice(parts, draw.integers(1, 14))) for _ in range(4000)]
    fast = Fast(VOCABULARY)
    for at in range(0, len(texts), 200):
        some = texts[at : at + 200]
        assert fast.encode(some) == [np.asarray(PLAIN.encode(t, add_special_tokens=False).ids, "<u4").tobytes() for t in some]
