"""Annotation files."""

import json

from lingolake.sources import files


def test_xmi(spark, tmp_path):
    sofas = spark.createDataFrame([(1, "_InitialView", 'A "b" & <c>\nd'), (2, "v", "x")], "doc_id long, view string, text string")
    notes = spark.createDataFrame([(1, "_InitialView", "GrammarAnomaly", 0, 3, "Ellipsis", "sluicing", None), (1, "_InitialView", "LexicalPhrase", 2, 3, None, None, "Q<E")], "doc_id long, view string, kind string, begin int, end int, description string, category string, label string")
    files.write_xmi(sofas, notes, str(tmp_path / "out"))
    for i in (1, 2):
        (tmp_path / f"{i}.xmi").write_text((tmp_path / f"out/{i}.xmi").read_text())
    (tmp_path / "broken.xmi").write_text("nothing")
    (tmp_path / "note.txt").write_text("<xmi:XMI>")
    back = files.read_xmi(spark, str(tmp_path)).collect()
    assert sorted((r["type"], r["begin"], r["end"], r["features"].get("category"), r["features"].get("text")) for r in back if r["prefix"] == "custom") == [("GrammarAnomaly", 0, 3, "sluicing", None), ("LexicalPhrase", 2, 3, None, "Q<E")]
    assert {r["features"]["sofaString"] for r in back if r["type"] == "Sofa"} == {'A "b" & <c>\nd', "x"}
    assert [r["file"].rsplit("/")[-1] for r in files.read_xmi(spark, str(tmp_path), failed=True).collect()] == ["broken.xmi"]


def test_gold_and_metrics(spark, tmp_path):
    example = {"id": "1", "text": "I do", "category": "VPE_RESOLVABLE", "is_vpe": True, "ellipsis_site": "do"}
    for name, value in (("a", [example]), ("b", {"examples": [example, example | {"id": "2"}]})):
        (tmp_path / f"{name}.json").write_text(json.dumps(value))
    assert files.read_gold(spark, str(tmp_path / "a.json")).count() == 1
    gold = files.read_gold(spark, str(tmp_path / "b.json"))
    assert sorted(r["id"] for r in gold.collect()) == ["1", "2"] and gold.first()["is_vpe"] is True
    files.write_metrics(gold.groupBy().count(), str(tmp_path / "m"))
    assert spark.read.json(str(tmp_path / "m")).first()["count"] == 2
