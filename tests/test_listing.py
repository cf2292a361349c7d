import json

import pytest

from tests.helpers import put_pages
from tributary.schemas import DATA_SETS, DIFFERENTIAL, FULL, TABLES, registry
from tributary.sources.listing import pages_in_order, read_listing, read_pages, resolve_links, select_data_sets


def links_of(spark, path):
    pages = pages_in_order(read_pages(spark, path, "Objects"))
    return {r["plugin"]: r["link"] for r in resolve_links(read_listing(pages)).collect()}


def test_pages_are_joined_and_the_last_link_wins(spark, tmp_path):
    pages = [[("a", "1"), ("b", "1"), ("a", "2")], [], [("c", "1"), ("b", "9")], [("b", "3")]]
    path = put_pages(f"{tmp_path}/l", pages)
    assert links_of(spark, path) == {"a": "2", "b": "3", "c": "1"}


@pytest.mark.parametrize("addressed", [True, False])
def test_page_ten_comes_after_page_two(spark, tmp_path, addressed):
    path = put_pages(f"{tmp_path}/l", [[("a", str(i))] for i in range(12)], addressed=addressed)
    assert links_of(spark, path) == {"a": "11"}


@pytest.mark.parametrize("number", [1, 2, 3, 8, 37])
def test_addresses_decide_not_names(spark, tmp_path, number):
    names = [f"p{n * 7919 % 10007}" for n in range(number)]
    path = put_pages(f"{tmp_path}/l", [[("a", str(i)), (f"b{i}", "x")] for i in range(number)], names=names)
    found = {r["link"]: r["page"] for r in read_listing(pages_in_order(read_pages(spark, path, "Objects"))).where("plugin = 'a'").collect()}
    assert found == {str(i): i + 1 for i in range(number)} and links_of(spark, path)["a"] == str(number - 1)


def rewritten(path, **fields):
    path.write_text(json.dumps({**json.loads(path.read_text()), **fields}))


def test_broken_chains_fail(spark, tmp_path):
    def broken(message, change):
        folder = tmp_path / message.replace(" ", "-").replace("/", "-")
        put_pages(folder, [[("a", str(i))] for i in range(6)])
        change(folder)
        with pytest.raises(ValueError, match=message):
            links_of(spark, str(folder))

    broken("not complete: page/3", lambda f: (f / "page-0003.json").unlink())
    broken("not complete: page/5", lambda f: (f / "page-0005.json").unlink())
    broken("not complete: page/9", lambda f: rewritten(f / "page-0005.json", NextPageUrl="page/9"))
    broken("two pages of one address", lambda f: rewritten(f / "page-0004.json", Url="page/3"))
    broken("2 last pages", lambda f: rewritten(f / "page-0003.json", NextPageUrl=None))
    broken("0 last pages", lambda f: rewritten(f / "page-0005.json", NextPageUrl="page/1"))
    broken("form a ring", lambda f: rewritten(f / "page-0002.json", NextPageUrl="page/1"))
    broken("pages fork", lambda f: rewritten(f / "page-0000.json", NextPageUrl="page/2"))
    broken("no pages", lambda f: [p.unlink() for p in f.iterdir()])


def test_data_sets_of_a_mode(spark):
    links = spark.createDataFrame([(p, f"to/{t}") for p, t, _ in DATA_SETS], "plugin string, link string")
    full = select_data_sets(registry(spark), links, FULL).collect()
    assert {r["table"]: r["link"] for r in full} == {t: f"to/{t}" for t in TABLES}
    differential = select_data_sets(registry(spark), links, DIFFERENTIAL).collect()
    assert [r["table"] for r in differential] == ["user_enrollments"]


def test_missing_link_fails(spark):
    links = spark.createDataFrame([(p, "x") for p, _, _ in DATA_SETS[1:]], "plugin string, link string")
    with pytest.raises(Exception, match=f"no link for data set {DATA_SETS[0][0]}"):
        select_data_sets(registry(spark), links, FULL).collect()


def test_pages_without_addresses_need_their_last_one(spark, tmp_path):
    path = put_pages(f"{tmp_path}/l", [[("a", "1")], [("b", "1")], []], addressed=False)
    assert links_of(spark, path) == {"a": "1", "b": "1"}
    (tmp_path / "l/page-0002.json").unlink()
    with pytest.raises(ValueError, match="not complete: page/2"):
        links_of(spark, path)


@pytest.mark.parametrize(
    "text,message",
    [
        ('{"Objects": [', "MALFORMED|Malformed"),
        ('{"Other": [], "Url": "page/1", "NextPageUrl": null}', "no Objects in"),
        ('{"Objects": [{"DownloadLink": "x"}], "Url": "page/1", "NextPageUrl": null}', "an item without PluginId"),
    ],
)
def test_a_page_of_another_form_fails(spark, tmp_path, text, message):
    path = put_pages(f"{tmp_path}/l", [[("a", "1")], []])
    (tmp_path / "l/page-0001.json").write_text(text)
    with pytest.raises(Exception, match=message):
        links_of(spark, path)
