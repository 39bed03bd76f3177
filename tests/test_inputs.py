from pathlib import Path

from gleanery.catalog import inputs
from gleanery.sources.text_files import scan_text_files


def test_exported_files_have_no_companions(spark, tmp_path):
    """One file a document, duplicates and nulls included, and no checksum file beside each, which costs as much as the file."""
    rows = [(1, "one", "en", "web"), (2, "one", "en", "web"), (3, None, None, "web"), (3, "thrée", "fr", None)]
    spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string").write.parquet(f"{tmp_path}/documents.parquet")
    inputs.export_text_files(spark, str(tmp_path), f"{tmp_path}/raw")
    names = [p.name for p in Path(tmp_path, "raw").rglob("*") if p.is_file() and p.name not in ("_SUCCESS", "._SUCCESS.crc")]
    assert len(names) == 4 and all(n.endswith(".txt") and not n.startswith(".") for n in names)
    texts = [bytes(r["content"]).decode() for r in scan_text_files(spark, f"{tmp_path}/raw").collect()]
    assert sorted(texts) == ["\n", "one\n", "one\n", "thrée\n"]


def test_repeated_exports_name_files_alike(spark, tmp_path):
    """The same row lies in the same file of every attempt, in the folders that Spark's own writer would make."""
    langs = ["en", "", None, "a/b=c %[x]^{y}", "ü\n"]
    rows = [(i, f"text {i % 7}" if i % 5 else None, langs[i % len(langs)], f"s{i % 2}") for i in range(60)]
    spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string").write.parquet(f"{tmp_path}/documents.parquet")

    def files(folder):
        return {str(p.relative_to(folder)): p.read_bytes() for p in folder.rglob("*.txt")}

    for name in ("one", "two"):
        inputs.export_text_files(spark, str(tmp_path), f"{tmp_path}/{name}")
    first = files(tmp_path / "one")
    assert len(first) == 60 and first == files(tmp_path / "two")
    inputs.table(spark, str(tmp_path), "documents").drop("doc_id").write.partitionBy("lang", "source").option("maxRecordsPerFile", 1).text(f"{tmp_path}/spark")
    held = sorted((name.rpartition("/")[0], text) for name, text in first.items())
    assert held == sorted((name.rpartition("/")[0], text) for name, text in files(tmp_path / "spark").items())
