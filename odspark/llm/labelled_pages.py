"""Hand-labelled pages that the HTML model is trained on (op 4).

The attribute data-keep marks the root of an article, data-drop a part inside it that does not belong to the article. Texts are invented; the
structures are those of common page layouts.
"""

from __future__ import annotations

_P1 = "The river rose through the night, and by morning the lower meadows were under water. Nobody in the village had seen it come so fast."
_P2 = "Engineers had warned of the old gates for years, but repairs were put off again and again while the council argued about money."
_P3 = "Now the work has begun. It will take most of the summer, and farmers say they can wait, provided that the promise is kept this time."
_P4 = "A small museum keeps the tools of the first builders. Visitors may handle them, and children ask why the handles are so short."
_AD = "Save up to half on garden tools this week only, order now and get free delivery to your door without any further costs."
_COOKIE = "We use cookies to make this site work and to measure visits. By going on you accept our policy and that of our partners."
_COMMENT = "I grew up near there and remember the flood well. My father lost his boat, and we never found out where it went."
_LEGAL = "All rights reserved. No part of this site may be copied without leave of the publisher. Terms of use and privacy apply."


def _links(words: str) -> str:
    return "".join(f'<li><a href="/{w}">{w}</a></li>' for w in words.split())


def _paragraphs(*texts: str) -> str:
    return "".join(f"<p>{t}</p>" for t in texts)


PAGES = [
    # news page with landmark elements
    f"<html><head><title>River</title></head><body><nav><ul>{_links('home news sport weather')}</ul></nav><div class=ad>{_AD}</div>"
    f"<article data-keep><h1>River over its banks</h1>{_paragraphs(_P1, _P2, 'Short line.', _P3)}</article><footer>&copy; example &middot; 2024 <a href=/t>terms</a></footer></body></html>",
    # the same with an unclosed article part, bold openings and line breaks
    f"<html><body><nav><a href=/a>Home</a> <a href=/b>News</a></nav><div class='ad'>{_P4}</div><article data-keep><h1>Old gates</h1>"
    f"<p><b>{_P2}<br><p>{_P1}</p><p>Of.</p><p><b>{_P3}<br></article><footer>&copy; site &middot; all</footer>",
    # blog with generic divisions, sidebar, comments
    f"<html><body><div id=header><div class=logo>The Daily Page</div><ul class=menu>{_links('about archive contact')}</ul></div><div id=main><div class='post' data-keep><h2>Museum of tools</h2>"
    f"<div class=entry-content>{_paragraphs(_P4, _P1)}<ul><li>Hammers of three sizes, all of oak and iron.</li><li>A plane with a bent blade.</li></ul>{_paragraphs(_P2)}</div>"
    f"<div class=share data-drop><a href=/s>Share</a> <a href=/m>Mail</a></div></div><div id=comments><h3>Comments</h3><div class=comment><p>{_COMMENT}</p></div><div class=comment><p>{_P3}</p></div>"
    f"<form><p>Leave a reply</p><label>Name</label><input><button>Send</button></form></div></div><div id=sidebar><h4>Related</h4><ul>{_links('floods gates farms')}</ul><p>{_AD}</p></div>"
    f"<div id=footer><p>{_LEGAL}</p></div></body></html>",
    # cookie notice and newsletter around a main element
    f"<html><body><div class='cookie-notice' role=dialog><p>{_COOKIE}</p><button>Accept</button></div><header><h1>Town Herald</h1><p>News since the old days, every day.</p></header>"
    f"<main data-keep><h2>Gates are mended</h2>{_paragraphs(_P3, _P2)}<blockquote><p>{_P4}</p></blockquote><aside data-drop><h3>More</h3><ul>{_links('one two three')}</ul></aside>{_paragraphs(_P1)}</main>"
    f"<section class=newsletter><h3>Our letter</h3><p>Get the best stories by mail each week, and leave whenever you want.</p><form><input><button>Go</button></form></section><footer><p>{_LEGAL}</p><ul>{_links('imprint privacy')}</ul></footer></body></html>",
    # article with a header of its own, figure and table
    f"<html><body><header class=site-header><a href=/>Logo</a><nav>{_links('a b c d')}</nav></header><div class=breadcrumb><a href=/>Home</a> &gt; <a href=/n>News</a></div><article class=story data-keep>"
    f"<header><h1>The long summer</h1><p class=lead>{_P3}</p></header><figure><img src=x><figcaption>The lower gate in May.</figcaption></figure>{_paragraphs(_P1, _P2)}"
    f"<table><tr><th>Year</th><th>Height</th></tr><tr><td>1999</td><td>4 m</td></tr></table>{_paragraphs(_P4)}<div class='advert' data-drop><p>{_AD}</p></div></article>"
    f"<div class=related><h3>You may also like</h3><p><a href=/1>{_P4}</a></p><p><a href=/2>{_P2}</a></p></div><div class=banner>{_AD}</div></body></html>",
    # plain divisions without telling names, text directly inside
    f"<html><body><div><a href=/1>Start</a> | <a href=/2>Map</a> | <a href=/3>Help</a></div><div data-keep><h1>Letter from the coast</h1><div>{_P1}</div><div>{_P2}</div><div>{_P4}</div></div>"
    f"<div><small>&copy; 2023</small> <a href=/i>Imprint</a></div></body></html>",
    # section layout, long notice, comments as a list
    f"<html><body><div class=notice>{_COOKIE}</div><section id=content data-keep><h1>Farms</h1><h2>Spring</h2>{_paragraphs(_P3, _P1)}<h2>Autumn</h2>{_paragraphs(_P2)}</section>"
    f"<section id=reader-comments><h2>Readers say</h2><ol class=comment-list><li><p>{_COMMENT}</p></li><li><p>{_P4}</p></li></ol></section><aside><p>{_AD}</p><p>{_P4}</p></aside><footer>{_LEGAL}</footer></body></html>",
    # page of one line, and a page of menus only
    f"<html><body><nav><ul>{_links('x y z')}</ul></nav><article data-keep><h1>Nothing</h1><p>Of.</p></article><footer>&copy; a &middot; b</footer></body></html>",
    f"<html><body><nav><ul>{_links('one two three four five')}</ul></nav><div class=ad>{_AD}</div><footer>&copy; b</footer></body></html>",
    # sponsored box, popup and login form between paragraphs
    f"<html><body><div class='top-bar'><ul>{_links('in out')}</ul></div><main><article data-keep><h1>Tools</h1>{_paragraphs(_P4)}<div class='sponsored promo' data-drop><p>{_AD}</p></div>{_paragraphs(_P2, _P3)}"
    f"<pre>gate --open lower</pre></article></main><div class=popup><p>{_COOKIE}</p></div><form class=login><p>Sign in to go on reading and to save your pages.</p><input></form><div class='widget tags'>{_links('river gate')}</div></body></html>",
]

# Parts that do not belong to an article, and articles; combined below into further pages.
_BEFORE = [
    f"<header><h1>Town Herald</h1><p>News since the old days, every day.</p></header><nav><ul>{_links('a b c')}</ul></nav>",
    f"<nav><a href=/>Home</a> <a href=/n>News</a></nav><div class=ad>{_AD}</div>",
    f"<div class=cookie-banner><p>{_COOKIE}</p><button>Accept all</button></div><header id=top><a href=/>Logo</a><p>{_P4}</p></header>",
    f"<div id=menu><ul>{_links('one two three')}</ul></div><div class='site-notice'>{_COOKIE}</div>",
    f"<aside class=sidebar><h3>Latest</h3><ul>{_links('x y')}</ul><p>{_P1}</p></aside>",
    f"<header class=page-header><div>Weather: rain</div><form><input><button>Search</button></form></header><div class='advertisement'><p>{_AD}</p><p>{_P3}</p></div>",
    f"<div class=ad>{_P2}</div>",
]
_ARTICLES = [
    "<article data-keep><h1>Short word word word</h1><p>Word word word word word word</p></article>",
    "<article data-keep><h1>Of</h1><p>Of</p></article>",
    f"<main data-keep><h1>Gates</h1>{_paragraphs(_P1, _P2)}<table><tr><th>Year</th><td>1999</td></tr></table><ul><li>one thing</li><li>two things</li></ul></main>",
    f"<div class=content data-keep><h2>Gates of old</h2>{_paragraphs(_P3, 'Yes', _P4)}<pre>run it</pre></div>",
    f"<article data-keep><header><h1>Meadows</h1><p>By a writer, in May</p></header><section><h2>One</h2>{_paragraphs(_P1)}</section><section><h2>Two</h2>{_paragraphs(_P2)}</section></article>",
    f"<article data-keep><h1>Lines</h1>{_paragraphs('word | word | word', 'word *** word $$$', _P3)}</article>",
    f"<div><div data-keep><h1>Plain</h1>{_paragraphs(_P1, _P4, _P2)}<div>{_P3}</div></div></div>",
]
_AFTER = [
    f"<section class=comments><h2>Comments</h2><div class=comment><p>{_COMMENT}</p></div><div class=comment><p>{_P2}</p></div></section><footer><p>{_LEGAL}</p></footer>",
    f"<aside><h3>Read on</h3><p>{_AD}</p><p>{_P4}</p></aside><footer>&copy; site &middot; all</footer>",
    f"<div id=comments><h2>Readers say</h2><ol><li><p>{_COMMENT}</p></li><li><article class=comment><p>{_P1}</p></article></li></ol></div><div class=footer>{_LEGAL}</div>",
    f"<form class=subscribe><h3>Letter</h3><p>{_P4}</p><input></form><footer><ul>{_links('imprint help')}</ul><p>{_P3}</p></footer>",
    f"<div class='related-posts'><h3>More</h3><p>{_P1}</p><ul>{_links('r s t')}</ul></div><div class=ads>{_AD}</div>",
    f"<aside id=right><div class=widget><p>{_P2}</p></div></aside><footer>{_LEGAL} {_P4}</footer>",
]
PAGES += [f"<html><body>{_BEFORE[k % 7]}{_ARTICLES[(k // 2 + k // 7) % 7]}{_AFTER[k % 6]}</body></html>" for k in range(42)]
PAGES += [
    f"<html><body><nav><ul>{_links('a b c d e f')}</ul></nav><div class=ad>{ad}</div><article data-keep><h1>{line}</h1><p><b>{line}</article><footer>&copy; a.example &middot; b</footer></body></html>"
    for ad, line in ((_AD, "Word in word."), (_P2, "Of the word and that word to word was word."), (_P4, "Word"), ("Buy.", "Word and word and word. Word"))
]
