"""Pages of many layouts, written by hand without a look at the generator's names: blocks and precision and recall over all."""

import pytest

from quantloom.llm import html_extract

P = "The old mill by the river has been turned into a library, and the first readers came on Sunday."
Q = "It holds four thousand books, most of them given by people who live in the streets around it."
R = "Opening hours are short for now, but the council hopes to find more helpers before the winter."
T = "A library in the mill"
D = "\n\n"

#: Pages whose every block is main text but for what is listed as no part of it.
CASES = {
    "unknown name": (f"<div class='xyzzy'><p>{P}</p><p>{Q}</p></div>", [P, Q]),
    "body without sidebar": (f"<body class='no-sidebar'><article><h1>{T}</h1><p>{P}</p><p>{Q}</p></article>", [T, P, Q]),
    "body with states": (f"<body class='has-sidebar no-comments'><article><h1>{T}</h1><p>{P}</p><p>{Q}</p></article>", [T, P, Q]),
    "comments open": (f"<body class='single-post comments-open'><article><h1>{T}</h1><p>{P}</p><p>{Q}</p></article>", [T, P, Q]),
    "layout with sidebar": (f"<div class='layout with-sidebar'><article><h1>{T}</h1><p>{P}</p><p>{Q}</p></article></div>", [T, P, Q]),
    "page with sidebar": (f"<div class='page with-sidebar'><div class='content'><h1>{T}</h1><p>{P}</p><p>{Q}</p></div></div>", [T, P, Q]),
    "information": (f"<div id='information'><p>{P}</p><p>{Q}</p></div>", [P, Q]),
    "information and class": (f"<div id='information' class='transformation'><p>{P}</p><p>{Q}</p></div>", [P, Q]),
    "plain body": (f"<body><p>{P}</p><p>{Q}</p></body>", [P, Q]),
    "apostrophe in a value": (f"<article><h1>{T}</h1><p>{P}</p><p data-x=it's>{Q}</p><p>{R} It isn't over.</p></article>", [T, P, Q, R + " It isn't over."]),
    "open quote in one tag": (f"<article><p>{P}</p><p title=\"open>{Q}</p><p>{R}</p></article>", [P, Q, R]),
    "mark in a later value": (f"<article><p title='a>b'>{P}</p><p title=\"open>{Q}</p><p data-y='c>d'>{R}</p></article>", [P, Q, R]),
    "table layout": (f"<table><tr><td><a href='/'>Start</a></td><td><a href='/k'>Kontakt</a></td></tr><tr><td colspan=2><h2>{T}</h2><p>{P}</p><p>{Q}</p></td></tr></table><div class=copyright>&copy; 2009 Mill</div>", [T, P, Q]),
    "role main": (f"<div role='banner'><a href='/'>Town</a></div><div role='navigation'><a href='/a'>News</a> <a href='/b'>Sport</a></div><div role='main'><h1>{T}</h1><p>{P}</p><p>{Q}</p></div><div role='contentinfo'><a href='/imprint'>Imprint</a></div>", [T, P, Q]),
    "hashed names": (f"<div class='css-1x2y3z'><div class='css-9f8e'><ul><li><a href='/1'>World</a></li><li><a href='/2'>Local</a></li></ul></div><div class='css-77aa'><h1>{T}</h1><div class='sc-bdVaJa'><p>{P}</p><p>{Q}</p><p>{R}</p></div></div></div>", [T, P, Q, R]),
    "blog": (f"<div id='wrap'><div id='hd'><h1><a href='/'>Mill notes</a></h1></div><div class='hentry'><h2><a href='/7'>{T}</a></h2><div class='entry'><p>{P}</p><p>{Q}</p></div></div><div class='sidebar'><h3>Archive</h3><ul><li><a href='/05'>May</a></li><li><a href='/06'>June</a></li></ul></div></div>", [P, Q]),
    "wiki": (f"<div id='mw-panel'><ul><li><a href='/r'>Random page</a></li></ul></div><div id='bodyContent'><p>{P}</p><h2>History</h2><p>{Q}</p><ul><li>1870: built</li><li>1999: closed</li></ul><p>{R}</p></div><div id='footer'><ul><li>Last edited in May.</li></ul></div>", [P, "History", Q, "1870: built", "1999: closed", R]),
    "press release": (f"<header><img src=x><nav><a href='/'>Home</a><a href='/pr'>Press</a></nav></header><section class='release'><h1>{T}</h1><p>{P}</p><blockquote><p>{Q}</p></blockquote><p>{R}</p></section><footer><p>&copy; Mill Ltd. All rights reserved.</p></footer>", [T, P, Q, R]),
    "documentation": (f"<div class='toctree'><ul><li><a href='#1'>Intro</a></li><li><a href='#2'>Use</a></li></ul></div><main><h1>{T}</h1><p>{P}</p><pre>mill --open</pre><p>{Q}</p></main>", [T, P, "mill --open", Q]),
    "paragraphs apart": (f"<div class='a1'><p>{P}</p></div><div class='a2'><p>{Q}</p></div><div class='a3'><p>{R}</p></div>", [P, Q, R]),
    "line breaks": (f"<div id='t'>{P}<br><br>{Q}</div>", [P + " " + Q]),
    "cookie bar first": (f"<div class='cookie-consent'><p>We use cookies to make this page better.</p><button>Fine</button></div><div id='story'><h1>{T}</h1><p>{P}</p><p>{Q}</p></div>", [T, P, Q]),
    "advert inside": (f"<article><h1>{T}</h1><p>{P}</p><div class='ad-slot'><p>Buy two, pay one!</p></div><p>{Q}</p></article>", [T, P, Q]),
    "reader comments": (f"<article><h1>{T}</h1><p>{P}</p><p>{Q}</p></article><section id='comments'><h3>2 comments</h3><ol><li><p>Lovely idea.</p></li><li><p>I gave ten books.</p></li></ol></section>", [T, P, Q]),
    "share and tags": (f"<main><article><h1>{T}</h1><p>{P}</p><p>{Q}</p><ul class='share-buttons'><li><a href='/f'>Post</a></li><li><a href='/m'>Mail</a></li></ul></article></main>", [T, P, Q]),
    "definition list": (f"<article><h1>{T}</h1><p>{P}</p><dl><dt>Open</dt><dd>Sunday to Tuesday, from ten to noon.</dd></dl><p>{Q}</p></article>", [T, P, "Open", "Sunday to Tuesday, from ten to noon.", Q]),
    "figure": (f"<article><h1>{T}</h1><figure><img src=m.jpg><figcaption>The mill in spring, seen from the bridge.</figcaption></figure><p>{P}</p><p>{Q}</p></article>", [T, "The mill in spring, seen from the bridge.", P, Q]),
    "upper case tags": (f"<BODY><DIV ID=nav><A HREF='/'>Home</A></DIV><DIV CLASS=Text><H1>{T}</H1><P>{P}<P>{Q}</DIV></BODY>", [T, P, Q]),
}


def found(page):
    return [x for x in html_extract.main_text(html_extract.default_model(), page).split(D) if x]


@pytest.mark.parametrize("name", list(CASES)[:12])
def test_articles_are_whole(name):
    page, want = CASES[name]
    assert found(page) == want


def test_precision_and_recall_over_layouts():
    right = wrong = missed = 0
    for name, (page, want) in CASES.items():
        got = found(page)
        right += sum(x in want for x in got)
        wrong += sum(x not in want for x in got)
        missed += sum(x not in got for x in want)
        assert got or name == "line breaks", name  # the one page that is still lost: a single block, in no element of a text
    assert right / (right + wrong) >= 0.93 and right / (right + missed) >= 0.98, (right, wrong, missed)
