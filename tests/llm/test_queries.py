"""The registered queries of the training-data operators over a whole small directory: the contract's
columns first and in order, one row per row where that is said, and SQL where there is some."""

import pytest

import __spark_entry__ as E
from tests.oracle_harness import compare, duck

SF = "/root/testdata/sf0.001"
# The columns that the results must begin with.
COLUMNS = {
    "op1_nearest": "query_id long, rank int, vec_id long, score double",
    "op3_mixing": "doc_id long, size long, source_size long, target double, taken long",
    "op4_packing": "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long",
    "op5_language": "doc_id long, held_out boolean, lang_pred string, score double",
    "op7_repetition": "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, kept boolean",
    "op8_url_filter": "page_id long, host string, path string, rule string, verdict string",
    "op9_minhash": "doc_id long, n_shingles long, component_id long, kept boolean",
    "op10_suffix_array": "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string",
    "op11_chat": "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long",
    "op12_repair": "conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string",
    "op13_merkle": "doc_id long, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean",
}
ONE_ROW_EACH = {"op3_mixing", "op5_language", "op7_repetition", "op9_minhash", "op10_suffix_array", "op13_merkle"}


def test_all_are_registered():
    numbers = sorted(int(n[2:].split("_")[0]) for n in E.queries() if n.startswith("op"))
    assert numbers == list(range(1, 14)) and "pipeline" in E.queries()


@pytest.mark.parametrize("name", sorted(COLUMNS))
def test_contract_columns(spark, name):
    found = E.queries()[name](spark, SF)
    wanted = [c.split() for c in COLUMNS[name].split(", ")]
    kinds = {"long": "bigint"}
    assert found.dtypes[: len(wanted)] == [(c, kinds.get(k, k)) for c, k in wanted]
    if name in ONE_ROW_EACH:
        ids = [r[0] for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id").collect()]
        assert sorted(r[0] for r in found.select("doc_id").collect()) == sorted(ids)


@pytest.mark.parametrize("name", sorted(set(E.oracle_sql()) & {n for n in E.queries() if n.startswith("op")}))
def test_query_matches_oracle(spark, name):
    r = compare(spark, duck(SF), name, E.queries()[name], E.oracle_sql()[name], SF)
    assert r["cols_match"] and r["hash_match"] and r["rows"][0] == r["rows"][1], r
