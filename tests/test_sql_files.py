"""S1 (FIXTURES H)."""

from tablewright.sources.sql_files import load_sql_files, load_sql_texts


def test_only_sql_files_are_loaded(tmp_path):
    for name in ("a.sql", "b.txt", "c.sql"):
        (tmp_path / name).write_text(f"select '{name}'")
    assert list(load_sql_files(str(tmp_path / "*.sql"))) == ["a", "c"]


def test_no_files_give_an_empty_mapping(tmp_path):
    assert load_sql_files(str(tmp_path / "*.sql")) == {}


def test_recursive_pattern_finds_nested_files(tmp_path):
    (tmp_path / "sub").mkdir()
    (tmp_path / "sub" / "test.sql").write_text("select 1")
    (tmp_path / "top.sql").write_text("select 2")
    found = load_sql_files(str(tmp_path / "**" / "*.sql"))
    assert found == {"test": "select 1", "top": "select 2"}


def test_order_is_by_path(tmp_path):
    for name in ("z.sql", "m.sql", "b.sql"):
        (tmp_path / name).write_text("select 1")
    assert list(load_sql_files(str(tmp_path / "*.sql"))) == ["b", "m", "z"]


def test_package_queries_are_shipped():
    assert list(load_sql_files()) == ["features", "index", "target"]


def test_texts_read_through_spark(spark, tmp_path):
    (tmp_path / "b.sql").write_text("select 2")
    (tmp_path / "a.sql").write_text("select 1")
    assert load_sql_texts(spark, str(tmp_path)) == {"a": "select 1", "b": "select 2"}


def test_two_files_with_one_stem_raise(tmp_path):
    import pytest

    (tmp_path / "a").mkdir()
    (tmp_path / "a" / "x.sql").write_text("select 1")
    (tmp_path / "x.sql").write_text("select 2")
    with pytest.raises(ValueError, match="share the name 'x'"):
        load_sql_files(str(tmp_path / "**" / "*.sql"))
