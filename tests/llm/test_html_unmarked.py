"""Pages whose menus, contact lines and comments no tag or role marks."""

import pytest

pytest.importorskip("public_tokenizers")

from riskloom.llm.html_extract import main_text  # noqa: E402

SENTENCE = "This is a sentence of the article, with some words, and more of them. "
ARTICLE = "".join(f"<p>{n}. {SENTENCE * 3}</p>" for n in range(8))
TEXT = "\n".join(f"{n}. {SENTENCE * 3}".strip() for n in range(8))
MENU = "<ul>" + "".join(f"<li><a href=/{i}>Menu item {i}</a></li>" for i in range(8)) + "</ul>"


@pytest.mark.parametrize("page", (
    f"<body>{MENU}{ARTICLE}<div>Contact us</div></body>",
    f"<body><div>{MENU}{ARTICLE}<div>Contact us</div></div></body>",
    f"<body>{ARTICLE}{MENU}</body>",
    f"<body><div>{ARTICLE}</div><div class=feedback><p>{'I think that this was good, really. ' * 9}</p></div></body>",
))
def test_only_the_article_is_left(page):
    assert main_text(page) == TEXT


def test_what_belongs_to_the_article_stays():
    page = f"<body><h1>Title</h1><div>By someone</div>{ARTICLE}<ul><li>one thing, short</li><li><a href=x>linked</a> and more words</li></ul>{ARTICLE}<p>End.</p></body>"
    assert main_text(page) == "\n".join(["Title", "By someone", TEXT, "one thing, short", "linked and more words", TEXT, "End."])
