"""Column names and types of every registered query of the subpackage, on the smallest table."""
import pytest

from starloom.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"
COLUMNS = {
    "op1": "doc_id bigint, n_tokens bigint, domain string, posterior double, rate double, copies bigint",
    "op2": "doc_id bigint, n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, n_repeat_words bigint,"
           " base_failed boolean, kept boolean, stratum string",
    "op3": "doc_id bigint, section int, first_char bigint, past_char bigint, n_tokens bigint, n_crossing bigint",
    "op4": "page_id bigint, payload_bytes bigint, payload_digest string, record_type string, refers_to bigint",
    "op5": "doc_id bigint, held_out boolean, score double, predicted int",
    "op6": "doc_id bigint, size bigint, text_crc32 bigint, law string, shard int, slot bigint, grown_shard int",
    "op7": "doc_id bigint, n_words bigint, n_removed bigint, kept_sha256 string",
    "op8": "doc_id bigint, item_id bigint, n_shared bigint, n_item int, containment double",
    "op9": "page_id bigint, url string, text string, n_chars bigint",
    "op10": "doc_id bigint, class_id bigint, n_links bigint",
    "op11": "doc_id bigint, n_runs bigint, start bigint, length bigint, period bigint, exponent_milli bigint, runs_sha256 string,"
            " collapsed_sha256 string, n_words bigint",
    "op12": "doc_id bigint, n_shingles bigint, component_id bigint, kept boolean",
    "op13": "word string, form string, root string, n bigint, n_near bigint, form_n bigint",
}


def test_every_operator_has_a_query():
    assert sorted(n.split("_")[0] for n in QUERIES) == sorted(COLUMNS)


@pytest.mark.parametrize("op", [op for op, columns in COLUMNS.items() if columns])
def test_columns(spark, op):
    name = next(n for n in QUERIES if n.split("_")[0] == op)
    got = QUERIES[name](spark, SF)
    assert ", ".join(f"{n} {t}" for n, t in got.dtypes) == COLUMNS[op]
