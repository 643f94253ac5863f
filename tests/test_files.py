"""Sources, sinks, composition and whole campaigns on small folders."""

import gzip
import json
import os

import pytest
from pyspark.sql import functions as F

from tallyloom import session
from tallyloom.functions.sizes import token_count
from tallyloom.operators import compose, existence
from tallyloom.plans import campaign, folder_queries
from tallyloom.sinks import documents as document_sinks
from tallyloom.sinks import tables as table_sinks
from tallyloom.sources import documents, keylists, listing, logs, sequences, tables
from tests.test_functions import LOG


def document(name, *entries, **more):
    return {
        "name": name, "sequences": list(entries), "modelSeeds": [1], "dialect": "d", "version": 1,
        **more,
    }


def protein(id_, n, **more):
    return {"protein": {"id": id_, "sequence": "M" * n, **more}}


def put(path, content):
    path.parent.mkdir(parents=True, exist_ok=True)
    if isinstance(content, dict):
        content = json.dumps(content, indent=2)
    if path.suffix == ".gz":
        path.write_bytes(gzip.compress(content.encode()))
    else:
        path.write_text(content, newline="")
    return path


def texts(folder):
    found = []
    for name in sorted(os.listdir(folder)):
        if name.startswith("part-"):
            raw = open(f"{folder}/{name}", "rb").read()
            found += (gzip.decompress(raw) if name.endswith(".gz") else raw).decode().splitlines()
    return found


def test_scan_ids(spark, tmp_path, rows):
    for id_ in ("a", "b.1", "bad id"):
        put(tmp_path / f"out/{id_}_data.json.gz", "{}")
    put(tmp_path / "pred/a/a_model.cif.gz", "x")
    put(tmp_path / "pred/a/b_model.cif.gz", "x")
    found = listing.scan_ids(spark, f"{tmp_path}/out/{{id}}_data.json.gz")
    assert rows(found, "id") == [("a",), ("b.1",)]
    nested = listing.scan_ids(spark, f"file://{tmp_path}/pred/{{id}}/{{id}}_model.cif.gz")
    assert rows(nested, "id") == [("a",)]
    assert rows(listing.scan_ids(spark, f"{tmp_path}/none/{{id}}.json")) == []
    kinds = listing.scan_artifacts(
        spark, {"o": f"{tmp_path}/out/{{id}}_data.json.gz", "n": f"{tmp_path}/none/{{id}}"}
    )
    assert rows(kinds, "kind", "id") == [("o", "a"), ("o", "b.1")]


def test_scan_inputs_and_token_counts(spark, tmp_path):
    put(tmp_path / "atox1.json", document("atox1", protein("A", 68)))
    put(tmp_path / "mapk1_dusp6.json", document("x", protein("B", 360), protein("C", 381)))
    put(tmp_path / "example_2pv7_data.json.gz", document("e", protein(["A", "B"], 298)))
    put(tmp_path / "letters.json", document("l", protein("AB", 10)))
    ligand = {"ligand": {"id": ["L"], "ccdCodes": ["ATP"]}}
    put(tmp_path / "mixed.json", document("m", ligand, protein("A", 5), {"other": {"id": "Q"}}))
    put(tmp_path / "empty.json", document("e"))
    df = documents.scan_inputs(spark, str(tmp_path))
    found = {r["id"]: r["n"] for r in df.select("id", token_count(F.col("sequences")).alias("n")).collect()}
    assert found == {
        "atox1": 68, "mapk1_dusp6": 741, "example_2pv7": 596, "letters": 10, "mixed": 5, "empty": 0,
    }
    mixed = df.where("id = 'mixed'").first()
    assert [e["kind"] for e in mixed["sequences"]] == ["ligand", "protein", None]
    assert mixed["model_seeds"] == [1] and mixed["version"] == 1
    mismatch = existence.quarantined(df, F.col("name") == F.col("id"))
    assert {r["id"] for r in mismatch.collect()} == {"mapk1_dusp6", "example_2pv7", "letters", "mixed", "empty"}
    assert existence.accepted(df, F.col("name") == F.col("id")).first()["id"] == "atox1"


def test_scan_does_not_read_what_is_not_asked(spark, tmp_path):
    put(tmp_path / "a.json", document("a", protein("A", 3)))
    plan = documents.scan_inputs(spark, str(tmp_path)).select("id")
    assert "from_json" not in plan._jdf.queryExecution().executedPlan().toString()


FASTA = ">6E3K_1|Chains A[auth A], x\nMKV\nLLA\n\n>pdb|3h7p|A > y\r\nGG\r\nCC\r\n>T1050\n>last\nWW"


def test_read_fasta(spark, tmp_path, rows):
    put(tmp_path / "a.fasta", FASTA)
    expected = [("6E3K_1|Chains", "MKVLLA"), ("T1050", ""), ("last", "WW"), ("pdb|3h7p|A", "GGCC")]
    assert rows(sequences.read_fasta(spark, str(tmp_path)), "id", "seq") == expected
    first = sequences.read_fasta(spark, str(tmp_path), stop=2)
    assert rows(first, "id") == [("6E3K_1|Chains",), ("pdb|3h7p|A",)]


def test_fasta_is_whole_over_many_splits(spark, tmp_path, rows):
    records = [(f"r{n}", "ACDEFGHIKL"[: n % 10 + 1] * 7) for n in range(200)]
    put(tmp_path / "a.fasta", "".join(f">{i} x\n{s[:30]}\n{s[30:]}\n" for i, s in records))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "512")
    try:
        assert rows(sequences.read_fasta(spark, str(tmp_path)), "id", "seq") == sorted(records, key=repr)
        head = sequences.read_fasta(spark, str(tmp_path), stop=30)
        assert rows(head, "id", "seq") == sorted(records[:30], key=repr)
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_fasta_stats(spark, tmp_path):
    put(tmp_path / "u.fasta", ">u\n" + "M" * 40 + "\n" + "M" * 36 + "\n")
    put(tmp_path / "six.fasta", "".join(f">c{n}\n{'A' * k}\n" for n, k in enumerate([148, 148, 242, 242, 233, 233])))
    stats = sequences.fasta_stats(sequences.read_fasta(spark, str(tmp_path)))
    found = {os.path.basename(r["file"]): tuple(r)[1:] for r in stats.collect()}
    assert found == {"u.fasta": (1, 76, 76, "monomer"), "six.fasta": (6, 1246, 242, "multimer")}


def test_sequence_tables(spark, tmp_path, rows):
    put(tmp_path / "p.tsv.gz", "Extra\tEntry\tSequence\nx\t007\tMK\ny\t1e5\tNA\n")
    assert rows(sequences.read_proteome(spark, str(tmp_path / "p.tsv.gz"))) == [("007", "MK"), ("1e5", "NA")]
    put(tmp_path / "c.csv", "id,sequence\na_b,MK:VL\n")
    assert rows(sequences.read_complexes(spark, str(tmp_path / "c.csv"))) == [("a_b", "MK:VL")]


def test_read_keys(spark, tmp_path, rows):
    put(tmp_path / "k.txt", "# head\n#x\n\np1_p2\n p3_p4 # why\n   \np2_p2\n")
    keys = keylists.read_keys(spark, str(tmp_path / "k.txt"))
    assert rows(keys) == [("p1_p2",), ("p2_p2",), ("p3_p4",)]
    assert rows(compose.distinct_members(keys)) == [("p1",), ("p2",), ("p3",), ("p4",)]
    plus = spark.createDataFrame([("a+b",)], "id string")
    assert rows(compose.distinct_members(plus, delimiter="+")) == [("a",), ("b",)]


def test_plan_ids_survive_as_text(spark, tmp_path, rows):
    ids = ["1e5", "NA", "007", "null"]
    plan = campaign.plan_batches(
        spark.createDataFrame([(i, 100) for i in ids], "id string, tokens bigint"),
        spark.createDataFrame([], "id string"),
    )
    path = str(tmp_path / "plan")
    table_sinks.write_plan(plan, path)
    table_sinks.write_plan(plan.where("id = 'NA'"), path)
    read = tables.read_plan(spark, path)
    assert rows(read) == rows(plan) and {r["id"] for r in read.collect()} == set(ids)
    assert os.path.exists(f"{path}/_SUCCESS")
    table_sinks.write_plan(plan.where("id = 'NA'"), path, refresh=True)
    assert rows(tables.read_plan(spark, path), "id") == [("NA",)]


def test_logs_are_numbered_over_blocks(spark, tmp_path, rows):
    lines = {f: [f"{f} line {n} " + "x" * (n % 13) for n in range(300)] for f in "ab"}
    for f, ll in lines.items():
        put(tmp_path / f"{f}.txt", "".join(x + "  \n" for x in ll))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "700")
    try:
        found = logs.scan_logs(spark, str(tmp_path)).collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    got = {f: {} for f in "ab"}
    for r in found:
        got[os.path.basename(r["file"])[0]][r["line_no"]] = r["line"]
    assert got == {f: {n: x.rstrip() for n, x in enumerate(ll)} for f, ll in lines.items()}


def test_runtime_observations(spark, tmp_path, rows):
    done_b = "Done processing fold input bb."
    size = "w x y z Calculating bucket size for input with {} tokens."
    put(tmp_path / "1.txt", "\n".join([LOG[0], LOG[1], LOG[4], size.format(7), size.format(9), LOG[3], done_b, size.format(5)]) + "\n")
    put(tmp_path / "2.txt", "\n".join([LOG[4], "noise", LOG[0]]) + "\n")
    expected = [(100, 12.5, "aa", True), (9, 10.0, "bb", True), (None, None, "aa", False)]
    columns = ["n_tokens", "runtime_sec", "done_processing", "complete"]
    ordered = logs.runtime_observations(logs.log_lines(spark, str(tmp_path)))
    assert rows(ordered, *columns) == expected
    numbered = logs.scan_logs(spark, str(tmp_path))
    assert rows(logs.runtime_observations(numbered, order=("line_no",)), *columns) == expected


@pytest.mark.parametrize("hot_rows", [2_000_000, 40])
def test_observations_of_one_long_log_read_in_blocks(spark, tmp_path, hot_rows):
    size = "w x y z Calculating bucket size for input with {} tokens."
    took = "Running model inference and extracting output structures for seeds (4,) took {} seconds."
    text = []
    for n in range(200):
        text += [size.format(n), "noise", took.format(n / 2), f"Done processing fold input i{n}."]
    put(tmp_path / "long.txt", "\n".join(text) + "\n")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "900")
    try:
        lines = logs.log_lines(spark, str(tmp_path))
        found = logs.runtime_observations(lines, hot_rows=hot_rows).collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert sorted((r["n_tokens"], r["runtime_sec"], r["done_processing"]) for r in found) == [
        (n, n / 2, f"i{n}") for n in range(200)
    ]


def test_scores_and_markdown(spark, tmp_path):
    put(tmp_path / "s/a.json.gz", {"ranking_score": 0.64, "chain": [1, 2], "iptm": None})
    put(tmp_path / "s/b.json.gz", {"ranking_score": 0.67, "iptm": 0.5, "ptm": 1.0})
    scores = documents.scan_scores(spark, str(tmp_path / "s"))
    report = scores.select(
        F.regexp_extract("path", r"(\w+)\.json", 1).alias("gpu"), "ranking_score"
    ).orderBy("gpu")
    table_sinks.write_markdown(report, str(tmp_path / "md"))
    assert texts(tmp_path / "md") == [
        "| gpu | ranking_score |", "| :--- | ---: |", "| a | 0.64 |", "| b | 0.67 |",
    ]
    table_sinks.write_markdown(spark.range(10_001), str(tmp_path / "long"))
    assert texts(tmp_path / "long") == ["| id |", "| ---: |", *(f"| {i} |" for i in range(10_001))]


def test_accounting(spark, tmp_path, rows):
    put(tmp_path / "a.txt", "JobID|MaxRSS|X\n1.0|007|\n1.b|12K|z\n")
    table = tables.read_accounting(spark, str(tmp_path / "a.txt"))
    table_sinks.write_accounting(table, str(tmp_path / "o"))
    assert texts(tmp_path / "o")[0] == "JobID\tMaxRSS\tX"
    assert rows(spark.read.csv(str(tmp_path / "o"), sep="\t", header=True)) == [("1.0", "007", None), ("1.b", "12K", "z")]


def test_model_arrays(spark, tmp_path):
    path = str(tmp_path / "m")
    spark.sql(
        "select 'a' id, 1 model, array(1.0D, 2.0D) plddt, array(array(array(3.0D))) logits"
    ).write.parquet(path)
    row = tables.read_model_arrays(spark, path).first()
    assert row["plddt"] == [1.0, 2.0] and row["logits"] == [[[3.0]]]


def test_write_inputs_is_write_if_absent_and_escapes(spark, tmp_path):
    path = str(tmp_path / "in")
    first = spark.createDataFrame([("a", 'M"K')], "id string, seq string")
    both = spark.createDataFrame([("a", "OTHER"), ("b", "VV")], "id string, seq string")
    document_sinks.write_inputs(first, path)
    document_sinks.write_inputs(both, path)
    found = {d["name"]: d for d in map(json.loads, texts(path))}
    assert found["a"]["sequences"] == [{"protein": {"id": "A", "sequence": 'M"K'}}]
    assert found["b"] == {
        "name": "b", "sequences": [{"protein": {"id": "A", "sequence": "VV"}}], "modelSeeds": [4],
        "dialect": "alphafold3", "version": 2,
    }


def test_write_inputs_keeps_one_document_an_id_and_reads_no_stored_one(spark, tmp_path, rows):
    path = str(tmp_path / "in")
    many = spark.createDataFrame(
        [("a", "Z", 0), ("a", "B", 1), ("b", "M", 5)], "id string, seq string, place int"
    ).repartition(3)
    document_sinks.write_inputs(many, path, order="place")
    assert rows(document_sinks.stored_ids(spark, path), "id") == [("a",), ("b",)]
    held = {d["name"]: d["sequences"][0]["protein"]["sequence"] for d in map(json.loads, texts(path))}
    assert held == {"a": "Z", "b": "M"}
    for name in os.listdir(path):  # stored documents that can't be read any more are still known
        if name.startswith("part-"):
            (tmp_path / "in" / name).write_text("no document\n")
    put(tmp_path / "in" / "part-99.txt", json.dumps(document("c", protein("A", 3))))
    document_sinks.write_inputs(spark.createDataFrame([("a", "X"), ("c", "X"), ("d", "Y")], "id string, seq string"), path)
    assert rows(document_sinks.stored_ids(spark, path), "id") == [("a",), ("b",), ("c",), ("d",)]
    assert sum('"name":"d"' in line for line in texts(path)) == 1 and not any('"X"' in line for line in texts(path))


def test_routed_records(spark, tmp_path, cache):
    keys = spark.createDataFrame([("mapk1_dusp6",), ("mapk1_none",)], "id string")
    document_sinks.write_routed(compose.compose(keys, cache.select("id", "name", "entries")), str(tmp_path / "r"))
    (whole,) = map(json.loads, texts(tmp_path / "r/sink=documents"))
    (other,) = map(json.loads, texts(tmp_path / "r/sink=quarantine"))
    assert len(whole["sequences"]) == 2 and other == {"id": "mapk1_none", "status": "missing_member"}


@pytest.fixture
def cache(spark, tmp_path):
    folder = tmp_path / "cache"
    put(folder / "mapk1_data.json.gz", document("mapk1", protein("A", 360, unpairedMsa=">q\nMK", templates=[{"m": 1}])))
    put(folder / "dusp6_data.json.gz", document("dusp6", protein("A", 381)))
    put(folder / "two_data.json.gz", document("two", protein("A", 1), protein("B", 1)))
    return documents.scan_inputs(spark, str(folder))


@pytest.mark.parametrize("hot_rows", [2_000_000, 2])
def test_compose(spark, tmp_path, cache, hot_rows):
    long_ok, longer, longest = ("_".join(["dusp6"] * n) for n in (25, 26, 1000))
    keys = ["mapk1_dusp6", "dusp6_dusp6", "mapk1_none", "two_dusp6", long_ok, longer, longest, "mapk1_dusp6"]
    df = compose.compose(
        spark.createDataFrame([(k,) for k in keys], "id string"),
        cache.select("id", "name", "entries"), hot_rows=hot_rows,
    )
    found = {r["id"]: r for r in df.collect()}
    assert {k: (r["status"], r["members"]) for k, r in found.items()} == {
        "mapk1_dusp6": ("ok", 2), "dusp6_dusp6": ("ok", 2), "mapk1_none": ("missing_member", 2),
        "two_dusp6": ("not_single", 2), long_ok: ("ok", 25), longer: ("ok", 26), longest: ("ok", 1000),
    }
    assert found["mapk1_none"]["name"] is None and found[long_ok]["name"] == long_ok

    path = str(tmp_path / "composed")
    document_sinks.write_composed(df, path)
    docs = {d["name"]: d for d in map(json.loads, texts(path))}
    assert set(docs) == {"mapk1_dusp6", "dusp6_dusp6", long_ok, longer, longest}
    assert docs["mapk1_dusp6"] == {
        "dialect": "alphafold3", "version": 2, "name": "mapk1_dusp6",
        "sequences": [
            {"protein": {"id": "B", "sequence": "M" * 360, "unpairedMsa": ">q\nMK", "templates": [{"m": 1}]}},
            {"protein": {"id": "C", "sequence": "M" * 381}},
        ],
        "modelSeeds": [1], "bondedAtomPairs": None, "userCCD": None,
    }
    assert list(docs["mapk1_dusp6"]) == [
        "dialect", "version", "name", "sequences", "modelSeeds", "bondedAtomPairs", "userCCD",
    ]
    assert [e["protein"]["id"] for e in docs[long_ok]["sequences"]] == list("BCDEFGHIJKLMNOPQRSTUVWXYZ")
    assert docs[longer]["sequences"][-1]["protein"]["id"] == "AA"
    ids = [e["protein"]["id"] for e in docs[longest]["sequences"]]
    assert len(set(ids)) == 1000 and ids[-1] == "ALM"


def test_compose_from_parsed_sequences(spark, tmp_path, cache, rows):
    keys = spark.createDataFrame([("mapk1_dusp6",)], "id string")
    df = compose.compose(keys, cache.select("id", "name", "sequences"))
    assert rows(df.select(token_count(F.col("sequences")))) == [(741,)]
    document_sinks.write_composed(df, str(tmp_path / "c"))
    assert [e["protein"]["id"] for e in json.loads(texts(tmp_path / "c")[0])["sequences"]] == ["B", "C"]


@pytest.mark.parametrize("hot_rows", [2_000_000, 2])
def test_total_size(spark, rows, hot_rows):
    keys = spark.createDataFrame([("a_b",), ("a_a",), ("a_x",), ("a_b",)], "id string")
    lookup = spark.createDataFrame([("a", 10), ("b", 5)], "id string, tokens bigint")
    found = compose.total_size(keys, lookup, hot_rows=hot_rows)
    assert rows(found, "id", "members", "tokens", "missing") == [
        ("a_a", 2, 20, 0), ("a_b", 2, 15, 0), ("a_x", 2, 10, 1),
    ]


def test_compose_positions(spark):
    rows = [("ok", n, f"m{n}", 2) for n in range(3)]
    rows += [("long", n, f"m{n}", 1) for n in range(2600)] + [("below", -1, "m", 4)]
    rows += [("twice", 0, "m", 1), ("twice", 0, "m", 1)]
    df = compose.compose_positions(
        spark.createDataFrame(rows, "k string, pos int, name string, size bigint"),
        "k", "pos", "name", "size",
    )
    found = {r["k"]: (r["status"], r["members"], r["name"], r["chains"], r["tokens"]) for r in df.collect()}
    assert found == {
        "ok": ("ok", 3, "m0_m1_m2", "B,C,D", 6),
        "long": ("ok", 2600, "_".join(f"m{n}" for n in range(2600)), found["long"][3], 2600),
        "twice": ("repeated_position", 2, None, None, 2),
        "below": ("negative_position", 1, None, None, 4),
    }
    letters = found["long"][3].split(",")
    assert len(set(letters)) == 2600 and letters[:2] == ["B", "C"] and letters[24:26] == ["Z", "AA"]


def test_complex_fasta_and_manifests(spark, tmp_path, rows):
    members = spark.createDataFrame(
        [("a+b", 1, "b", "VV"), ("a+b", 0, "a", "MK")], "complex string, pos int, id string, seq string"
    )
    table_sinks.write_complex_fasta(members, str(tmp_path / "f"))
    (folder,) = (tmp_path / "f").glob("complex=*")
    assert texts(folder) == [">a", "MK", ">b", "VV"]
    plan = spark.createDataFrame([("x", 0), ("y", 0), ("z", 4)], "id string, batch_id bigint")
    table_sinks.write_manifests(plan, str(tmp_path / "m"), [F.concat("id", F.lit(".a3m")), F.concat("id", F.lit(".m8"))])
    assert sorted(texts(tmp_path / "m" / "batch_id=0")) == ["x.a3m", "x.m8", "y.a3m", "y.m8"]
    assert texts(tmp_path / "m" / "batch_id=4") == ["z.a3m", "z.m8"]


def test_plan_folder(spark, tmp_path):
    lengths = {"s16": 16, "s17": 17, "mid": 300, "done": 400, "s6000": 6000, "s6001": 6001}
    for id_, n in lengths.items():
        put(tmp_path / f"inputs/{id_}.json", document(id_, protein("A", n)))
        put(tmp_path / f"outputs/{id_}_data.json.gz", "{}")
    put(tmp_path / "inputs/unfinished.json", document("unfinished", protein("A", 50)))
    put(tmp_path / "outputs/orphan_data.json.gz", "{}")
    put(tmp_path / "predictions/done/done_model.cif.gz", "x")
    found = campaign.plan_folder(spark, str(tmp_path), hours=1)
    plan = found.plan.orderBy("tokens").collect()
    assert [(r["id"], r["tokens"], r["batch_id"]) for r in plan] == [("s17", 17, 0), ("mid", 300, 0), ("s6000", 6000, 1)]
    assert plan[0]["json"] == f"{tmp_path}/inputs/s17.json"
    counts = {r["step"]: (r["n"], r["total"]) for r in found.progress.collect()}
    assert counts == {"checked": (4, 6), "finished": (1, 6), "pending": (3, 6)}
    assert [r["id"] for r in found.unmatched.collect()] == ["orphan"]


def tasks_of(folder):
    """Numbers of the tasks that wrote a folder's files, and the files."""
    files = [p for p in folder.rglob("part-*") if not p.name.endswith(".crc")]
    return {p.name.split("-")[1] for p in files}, files


def test_one_file_each_is_written_by_many_tasks(spark, tmp_path):
    rows = spark.range(40).coalesce(1).select(F.concat(F.lit("s."), F.col("id") % 20).alias("id"), F.lit("x").alias("value"))
    folder_queries._one_file_each(rows, str(tmp_path / "out"))
    tasks, files = tasks_of(tmp_path / "out")
    assert len(tasks) > 1
    assert len(files) == 20


def test_file_each_needs_no_process_for_permissions(spark, tmp_path):
    """Names as Spark writes them, several lines, null lines and null ids; no file is left beside."""
    data = [("a:b/c", "x"), ("a:b/c", None), (None, "n"), ("", "e"), ("ü k", "z")] * 2
    rows = spark.createDataFrame(data, "id string, value string")
    table_sinks.write_file_each(rows, "id", f"file://{tmp_path}/own")
    rows.repartition("id").write.partitionBy("id").text(f"{tmp_path}/spark", compression="gzip")

    def held(folder):
        return sorted(tuple(r) for r in spark.read.text(str(tmp_path / folder)).select("value", F.coalesce("id", F.lit("-"))).collect())

    def names(folder):
        return {p.name for p in (tmp_path / folder).iterdir() if p.is_dir()}

    assert held("own") == held("spark") and names("own") == names("spark")
    # Hadoop's local files have a second one of checksums, made with the permissions of both.
    assert all(p.name.startswith("part-") for p in (tmp_path / "own").rglob("*") if p.is_file())


def test_only_mounted_folders_are_written_directly(spark):
    assert session.mounted(spark, "file:///a/b") == session.mounted(spark, "/a/b") == "/a/b"
    assert session.mounted(spark, "hdfs://host/a") is None


def test_names_are_listed_by_few_tasks(spark, tmp_path):
    for i in range(60):
        (tmp_path / f"id={i}").mkdir()
        (tmp_path / f"id={i}/part-0").write_text("x")
    before, last = spark.conf.get(listing._LISTING), max(spark.sparkContext.statusTracker().getJobIdsForGroup(None), default=-1)
    assert listing.scan_ids(spark, f"{tmp_path}/id={{id}}/part-*").count() == 60
    tracker = spark.sparkContext.statusTracker()
    jobs = [tracker.getJobInfo(j) for j in tracker.getJobIdsForGroup(None) if j > last]
    stages = [tracker.getStageInfo(k) for j in jobs for k in j.stageIds]
    assert max(s.numTasks for s in stages if s) <= listing._LISTING_TASKS * spark.sparkContext.defaultParallelism
    assert spark.conf.get(listing._LISTING) == before


def test_folders_are_written_by_many_tasks(spark, tmp_path):
    plan = spark.range(40).coalesce(1).select((F.col("id") % 20).alias("batch_id"), F.lit("a").alias("json"))
    table_sinks.write_manifests(plan, str(tmp_path / "out"), [F.col("json")])
    tasks, files = tasks_of(tmp_path / "out")
    assert len(tasks) > 1
    assert len(files) == 20


def test_distinct_keys_are_dealt_by_their_number(spark, rows):
    keys = spark.range(100).select(F.concat(F.lit("a_b"), F.col("id") % 50).alias("id"))
    hot = spark.createDataFrame([("a", 100)], "member string, _n bigint")
    for members in (None, hot):
        dealt = compose.distinct_keys(keys, members, task_keys=10)
        assert dealt.rdd.getNumPartitions() == 10
        assert rows(dealt) == sorted(((f"a_b{i}",) for i in range(50)), key=repr)


def test_member_rows_hold_no_chains_and_no_known_names(spark, rows):
    cache = spark.createDataFrame(
        [("a", "a", [("protein", ["A"], "MM")]), ("b", "B", [("rna", ["A"], "U")]), ("c", None, [("dna", ["A"], "T")])],
        "id string, name string, sequences array<struct<kind string, chain_ids array<string>, sequence string>>",
    )
    slim = compose._member_rows(cache, "sequences")
    assert slim.schema["_entry"].dataType.names == ["kind", "sequence"]
    assert rows(slim, "member", "_same", "_name") == [("a", True, None), ("b", False, "B"), ("c", False, None)]
    keys = spark.createDataFrame([("a_a",), ("a_b",), ("c_a",)], "id string")
    composed = compose.compose(keys, cache)
    assert rows(composed, "id", "name", "status") == [("a_a", "a_a", "ok"), ("a_b", "a_B", "ok"), ("c_a", "a", "ok")]
    twice = compose.compose(keys.where("id = 'a_a'"), cache.where("id = 'a'").unionAll(cache.where("id = 'a'")))
    assert rows(twice, "id", "name", "members") == [("a_a", "a_a_a_a", 2)]


def test_members_are_dealt_out_before_they_are_listed(spark):
    keys = spark.createDataFrame([("a_b",)], "id string")
    cache = spark.createDataFrame([("a", "a", [("rna", ["A"], "U")])], "id string, name string, sequences array<struct<kind string, chain_ids array<string>, sequence string>>")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = compose.compose(keys, cache)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    lists = [line for line in plan.split("\n") if "collect_list" in line or "Exchange hashpartitioning(id" in line]
    assert "partial_collect_list" in lists[1] and "REPARTITION_BY_NUM" in lists[2]
