import pytest

from tests.helpers import put_extract
from tributary.schemas import USER_ENROLLMENTS
from tributary.sources.tables import KeyedTable
from tributary.streaming.incremental import follow


def drain(table, tmp_path, **options):
    query = follow(table, f"{tmp_path}/landing", f"{tmp_path}/checkpoint", **options)
    query.awaitTermination()


def rows(table):
    return sorted(tuple(r) for r in table.read().select("org_unit_id", "user_id", "role_name").collect())


@pytest.mark.parametrize("share", [0.0, 1e9])
@pytest.mark.parametrize("per_batch", [1, 10])
def test_extracts_apply_in_sequence_whatever_the_landing_order(spark, tmp_path, share, per_batch):
    (tmp_path / "landing").mkdir()
    table = KeyedTable(spark, f"{tmp_path}/tables", USER_ENROLLMENTS, pending_share=share)
    table.create()
    put_extract(f"{tmp_path}/landing/e-3.zip", "1,1,third,,\n2,1,third,,\n")
    drain(table, tmp_path, archives_per_batch=per_batch)
    assert rows(table) == [(1, 1, "third"), (2, 1, "third")]
    put_extract(f"{tmp_path}/landing/e-2.zip", "1,1,second,,\n3,1,second,,\n")
    put_extract(f"{tmp_path}/landing/e-10.zip", "2,1,tenth,,\n")
    put_extract(f"{tmp_path}/landing/e-1.zip", "3,1,first,,\n4,1,first,,\n4,1,first again,,\n")
    drain(table, tmp_path, archives_per_batch=per_batch)
    wanted = [(1, 1, "third"), (2, 1, "tenth"), (3, 1, "second"), (4, 1, "first again")]
    assert rows(table) == wanted
    version = table.state().version
    drain(table, tmp_path)
    assert table.state().version == version
    table.fold()
    assert rows(table) == wanted


def test_a_failed_batch_is_tried_again(spark, tmp_path):
    table = KeyedTable(spark, f"{tmp_path}/tables", USER_ENROLLMENTS)
    put_extract(f"{tmp_path}/landing/e-1.zip", "1,x,role,,\n")
    with pytest.raises(Exception, match="not a bigint"):
        drain(table, tmp_path)
    assert rows(table) == []
    put_extract(f"{tmp_path}/landing/e-1.zip", "1,5,role,,\n")
    drain(table, tmp_path)
    assert rows(table) == [(1, 5, "role")]


def test_an_archive_without_a_number_fails(spark, tmp_path):
    table = KeyedTable(spark, f"{tmp_path}/tables", USER_ENROLLMENTS)
    put_extract(f"{tmp_path}/landing/latest.zip", "1,5,role,,\n")
    with pytest.raises(Exception, match="no extract number in"):
        drain(table, tmp_path)


def test_a_new_checkpoint_is_a_new_stream(spark, tmp_path):
    table = KeyedTable(spark, f"{tmp_path}/tables", USER_ENROLLMENTS)
    put_extract(f"{tmp_path}/landing/e-1.zip", "1,5,role,,\n")
    drain(table, tmp_path)
    (tmp_path / "checkpoint").rename(tmp_path / "checkpoint-before")
    put_extract(f"{tmp_path}/landing/e-2.zip", "2,5,role,,\n")
    drain(table, tmp_path)
    assert rows(table) == [(1, 5, "role"), (2, 5, "role")]
