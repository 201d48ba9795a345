"""Cases that the contracts leave to the operators: null ids and texts, contradictory labels, equal results of the filters."""
import random
import time

import numpy as np
from pyspark.sql import functions as F

from otif.llm import decontam, secrets, sharding, substring, toxicity, urls

SF = "/root/testdata/sf0.001"


def test_a_null_text_has_the_checksum_of_no_bytes(docs_of):
    rows = {r["doc_id"]: r for r in sharding.shard_by_bytes(docs_of([(1, None), (2, ""), (3, "abc")]), 2).collect()}
    assert rows[1]["text_crc32"] == rows[2]["text_crc32"] == 0 and rows[3]["text_crc32"] == 0x352441C2


def test_a_null_id_is_not_held_out(spark):
    ids = spark.createDataFrame([(None,), (0,), (1,), (2,)], "doc_id long")
    assert ids.select(toxicity.held_out(F.col("doc_id")).alias("h")).filter("h is null").count() == 0


def test_contradictory_labels_count_as_toxic(spark, docs_of):
    rows = [(i, f"vile words here number{i}" if i % 2 else f"kind words there number{i}") for i in range(400)]
    labels = spark.createDataFrame([(i, i % 2) for i in range(400)] + [(i, 0) for i in range(400)], "doc_id long, toxic int")
    model = toxicity.fit(docs_of(rows), labels)
    assert model.trained and model.score("vile words here") > 0.7 > model.score("kind words there")


def test_sketches_leave_no_match_out():
    rnd = random.Random(12)
    vocabulary = [f"w{i}" for i in range(300)]
    items = [(i, " ".join(rnd.choices(vocabulary, k=rnd.choice([8, 15, 40, 120])))) for i in range(60)]
    texts = []
    for _, text in items:
        words = text.split()
        for _ in range(int(0.2 * len(words))):
            words[rnd.randrange(len(words))] = rnd.choice(vocabulary)
        texts.append(" ".join(rnd.choices(vocabulary, k=rnd.randrange(30)) + words + rnd.choices(vocabulary, k=rnd.randrange(30))))
    index = decontam.Index(items)
    found = index.scan([*texts, None, "", "w1"])
    index.sketches[:] = 0  # every hit is plausible
    assert found == index.scan([*texts, None, "", "w1"])


def test_passages_without_marks_are_found_at_any_place(docs_of):
    rnd = random.Random(4)
    vocabulary = [f"w{i}" for i in range(20_000)]
    rows = []
    for i in range(100):
        passage = rnd.choices(vocabulary, k=51)
        rows += [(2 * i + k, " ".join([*rnd.choices(vocabulary, k=rnd.randrange(200)), *passage, *rnd.choices(vocabulary, k=rnd.randrange(200))])) for k in (0, 1)]
    found = [(r["first_doc_id"], r["doc_id"]) for r in substring.repeated_runs(docs_of(rows)).collect()]
    assert len(found) > 95 and set(found) <= {(2 * i, 2 * i + 1) for i in range(100)}


def test_cuts_depend_on_neighbours_only():
    rnd = np.random.default_rng(3)
    for trial in range(50):
        hashes, last = rnd.integers(0, 40, 60, dtype=np.uint64), rnd.random(60) < 0.1
        last[-1] = True
        cut = substring.inner_cuts(hashes, last)
        for i in range(60):
            around = range(i - substring.NEAR, i + substring.NEAR + 1)
            inner = around[0] >= 0 and around[-1] < 60 and not last[list(around)].any()
            assert cut[i] == (inner and all(hashes[i] < hashes[j] for j in around if j != i))
    assert not substring.inner_cuts(np.zeros(0, np.uint64), np.zeros(0, bool)).any()


def test_repeated_runs_equal_brute_force(spark, docs_of):
    """Every repeated digest of the whole table, runs of neighbours, the earliest occurrence kept."""
    rows = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").orderBy("doc_id").collect()
    seen, runs = {}, set()
    for doc_id, text in rows:
        u = substring.spans([text or ""])
        run = []
        for i in range(len(u["words"]) + 1):
            key = (u["hi"][i], u["lo"][i]) if i < len(u["words"]) else None
            if key is not None and key in seen:
                run.append(i)
                continue
            if sum(u["words"][j] for j in run) >= substring.MIN_WORDS:
                runs.add((doc_id, int(u["start"][run[0]]), int(u["end"][run[-1]]), int(sum(u["words"][j] for j in run)), len(run), *seen[u["hi"][run[0]], u["lo"][run[0]]]))
            run = []
            if key is not None:
                seen[key] = (doc_id, int(u["start"][i]))
    got = substring.repeated_runs(docs_of([tuple(r) for r in rows])).select("doc_id", "start", "end", "words", "units", "first_doc_id", "first_start")
    got = [tuple(r) for r in got.collect()]
    assert len(got) == len(runs) > 0 and set(got) == runs


def test_random_letters_are_secrets_and_words_are_not(docs_of):
    secret = {1: "pwd: kqzvxwjtrmph", 2: "auth=kqzvxwjt4821", 3: "bearer: mfrggzdfmztwq2lk", 4: "credentials: zqjxkvbwphgmtdrs", 5: "password is qzxkvjwpbhgmtn"}
    plain = {6: "the password is incorrect", 7: "an incorrect answer", 8: None, 9: "", 10: "auth: required"}
    got = {r["doc_id"]: r for r in secrets.find_secrets(docs_of([*secret.items(), *plain.items()])).collect()}
    for i, text in secret.items():
        value = text.split()[-1].split("=")[-1]
        assert got[i]["spans"] == f"value:{text.index(value)}:{len(text)}" and got[i]["n_value"] == 1
    assert all(got[i]["n_value"] == 0 for i in plain)
    assert "incorrect" in secrets.lexicon(docs_of([*plain.items()])) and "kqzvxwjtrmph" not in secrets.lexicon(docs_of([*secret.items()]))
    assert secrets.find_secrets(docs_of([])).count() == 0


def test_contexts_of_long_texts_are_searched_in_linear_time():
    began = time.monotonic()
    assert secrets.scan("a-" * 100_000) == [] and secrets.scan("token " * 50_000) == [] and secrets.scan("a_" * 100_000 + "password") == []
    assert [x[1] for x in secrets.scan("a-" * 100_000 + "pwd: hT9$kq!2Zv3Lw")] == [3]
    assert time.monotonic() - began < 3


def test_long_urls_and_an_empty_table(spark):
    began = time.monotonic()
    long = "https://example.org/" + "é/x" * 40_000
    pages = spark.createDataFrame([(1, long), (2, long), (3, "https://news.example.org/es/31/"), (4, "://"), (5, None)], "page_id long, url string")
    got = {r["page_id"]: r for r in urls.judge(pages).collect()}
    assert got[1]["path"] == long[len("https://example.org"):] and got[1]["score"] == got[2]["score"] and got[3]["verdict"] == "allow" and got[4]["score"] == got[5]["score"]
    assert time.monotonic() - began < 60
    assert urls.judge(pages.limit(0)).count() == 0
