"""Broken and hostile markup: every page is read forwards once, and what browsers fold away is not text."""

import time

import pytest

from tessera.llm import htmltext

SIZE = 1_000_000
PAGES = {"quotes": '<a ' + '"' * SIZE, "pairs": "<a " + "\"'" * (SIZE // 2) + ">x", "open tags": "<a " * (SIZE // 3), "stray ends": "<div></x>" * (SIZE // 9),
         "nested": "<div>" * (SIZE // 5), "paragraph and table": "<p><table>" + "<div>" * (SIZE // 5), "signs": "<" * SIZE, "items": "<li>" * (SIZE // 4),
         "comments": "<!--" * (SIZE // 4), "quoted ends": '<a "' * (SIZE // 4) + ">", "attributes": "<a " + "x " * (SIZE // 2) + ">", "slashes": "</" * (SIZE // 2)}


@pytest.mark.parametrize("name", PAGES)
def test_long_broken_markup_is_read_in_linear_time(name):
    page, took = PAGES[name], []
    for part in (page[:SIZE // 8], page):
        began = time.process_time()
        htmltext.render(htmltext.parse(part))
        took.append(time.process_time() - began)
    assert took[1] < 16 * max(took[0], 0.25)        # eight times the page, about eight times the time


def test_texts_of_broken_tags():
    show = lambda page: htmltext.render(htmltext.parse(page))
    assert show("a < b & <3 <a ") == "a < b & <3 <a"
    assert show('<b title="x>y">in</b> <i title="no partner>out') == "in out"
    assert show("one<!-- two > three --> four<!doctype x>five") == "one fourfive"
    assert show("<dialog>no</dialog><dialog open>yes</dialog>") == "yes"
    assert show("<details>no<summary>S</summary>no</details><details open><summary>T</summary>seen</details>") == "S\nT\nseen"
