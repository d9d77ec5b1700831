"""The small labelled table of the block classifier: pages as (fragment, label) pairs.

All text blocks of a fragment carry its label: 1 main text, 0 boilerplate, None
no text.  The pages are invented for this package.  Each is in the table twice: as
it is, and with markup that names nothing (``plain``), where only words, links and
neighbours tell the blocks apart; parts that these cannot tell are left out there.
"""

import re

_LONG = ("The river rose twice in the spring, and each time the people of the lower town carried their belongings up "
         "to the school, where the teachers had cleared the gymnasium and set out rows of folding beds for them.")
_MID = "Nobody could say at first how much of the harvest had been lost to the water."
_SHORT = "It rained again."

PAGES = [
    [("<nav><a href=/>Home</a><a href=/n>News</a><a href=/s>Sport</a></nav>", 0),
     ("<div class='ad'>Cheap flights to the south, book now and save half.</div>", 0),
     (f"<article><h1>The river town</h1><p>{_LONG}</p><p>{_SHORT}</p><p>Yes.</p><p>{_MID}</p><p>{_LONG}</p>", 1),
     ("</article>", None), ("<footer>&copy; 2020 The Daily &middot; All the words in this place are ours to keep.</footer>", 0)],
    [("<header><div>The Valley Paper</div><ul><li><a href=/a>Politics</a><li><a href=/b>Culture</a></ul></header>", 0),
     (f"<main><article><header><h1>Bread and salt</h1></header><p>{_MID}</p><p>{_LONG} <a href=/x>More here</a>.</p>", 1),
     ("<aside><h2>Related</h2><p>Five things the baker never told you about the price of flour.</p></aside>", 0),
     (f"<h2>The mill</h2><p>{_LONG}</p><ul><li>{_MID}</li><li>One sack of flour</li><li>Salt</li></ul>"
      f"<blockquote>{_SHORT}</blockquote><table><tr><td>1901</td><td>Forty sacks</td></tr></table>", 1),
     ("</article></main>", None),
     ("<section id='comments'><h3>Comments</h3><div class='comment'><p>I was there that year and it was nothing like "
      "this, the whole street stood under water for a month and no one came.</p></div><p>Thanks.</p></section>", 0),
     ("<div class='sidebar'><p>Subscribe to the weekly letter and read about the valley every Friday morning.</p></div>", 0)],
    [("<div id='cookie-notice'><p>We use cookies to make this site work and to learn how it is used by our readers.</p>"
      "<button>Accept</button></div>", 0),
     ("<div class='menu'><span>Start</span> <span>Archive</span> <span>About us and our long history here</span></div>", 0),
     (f"<div class='content'><h1>Slow trains</h1><p>{_LONG}</p><p>{_MID}</p><p>No.</p><p>{_LONG}</p>", 1),
     ("<form><label>Your name</label><p>Tell us what you think about the slow trains of the north.</p></form>", 0),
     ("</div>", None), ("<div class='footer'>Imprint and contact, Market Street 4, open on weekdays until five.</div>", 0)],
    [("<div><a href=/1>One</a> | <a href=/2>Two</a> | <a href=/3>Three</a></div>", 0),
     (f"<div><h1>Plain page</h1><p>{_LONG}</p><p>{_LONG}</p><p>{_SHORT}</p><p>{_MID}</p></div>", 1),
     ("<div><a href=/p>Previous page</a> <a href=/q>Next page</a></div>", 0),
     ("<div role='contentinfo'><p>All rights belong to the people who wrote these pages over the years.</p></div>", 0)],
    [("<table><tr><td><a href=/i>Index</a></td><td><a href=/j>Journal</a></td></tr></table>", 0),
     (f"<h1>Old style</h1>{_LONG}<br>{_MID}<p>{_LONG}</p><p>{_LONG}</p>", 1),
     ("<p><a href=/k>Back to the index of all journals</a></p>", 0)],
    [("<div role='banner'><p>Welcome to the village site, the best place for news of the village.</p></div>", 0),
     ("<div class='breadcrumbs'>Village &gt; News &gt; Fairs</div>", 0),
     (f"<section><h1>The autumn fair</h1><p>{_MID}</p><p>{_LONG}</p>", 1),
     ("<div class='share-buttons'>Share this story with your friends and neighbours</div>", 0),
     (f"<p>{_LONG}</p><figure><figcaption>{_MID}</figcaption></figure>", 1),
     ("<div class='promo'>Advertisement: the new plough that every farmer in the county talks about this year.</div>", 0),
     ("</section>", None),
     ("<ol class='comment-list'><li><article class='comment'><p>What a fair it was, and what a pity that the rain came "
      "so early in the day.</p></article></li></ol>", 0)],
    [("<ul><li><a href=/c>Contact</a></li><li><a href=/t>Terms of use</a></li></ul>", 0),
     (f"<main><h1>Notes</h1><p>{_SHORT}</p><p>{_SHORT}</p><p>Done.</p></main>", 1),
     ("<div class='newsletter'><p>Sign up today.</p></div>", 0), ("<footer><p>Made by hand.</p></footer>", 0)],
    [(f"<article><p>{_SHORT}</p></article>", 1), ("<footer>Page 3 of 9</footer>", 0)],
    [("<div class='alert'>This shop is closed until further notice because of the weather.</div>", 0),
     (f"<article><p>See <a href=/d>the drawing of the harbour from the year of the flood</a></p><p>{_LONG}</p>"
      "<pre>depth  4\nwidth 12</pre>", 1),
     ("<p><a href=/e>The second drawing</a></p>", 1), ("</article>", None),
     ("<div class='widget'><p>Most read</p><p><a href=/f>The harbour at night</a></p></div>", 0)],
    [("<div class='top-menu'><a href=/u>Farms</a> <a href=/v>Markets</a></div>", 0),
     (f"<article class='share-post'><h1>Open gates</h1><p>{_LONG}</p><p>{_MID}</p><p>{_LONG}</p></article>", 1),
     ("<div><p>Copyright 2020 The Farmer. All rights reserved.</p></div>", 0)],
    [(f"<div class='article-with-sidebar'><h1>Low tide</h1><p>{_LONG}</p><p>{_LONG}</p><p>{_MID}</p></div>", 1),
     ("<div class='sidebar-content'><p>Tides today</p><p><a href=/w>All tides</a></p></div>", 0),
     ("<div class='footer-text'><p>&copy; 2019 Harbour office, all rights reserved</p></div>", 0)],
    [(f"<div class='post form-group'><p>{_LONG}</p><p>{_LONG}</p><p>{_MID}</p></div>", 1),
     ("<div class='comment-body'><p>Nice one.</p><p>Me too.</p></div>", 0)],
    [("<article><p>The copyright of the song went to her daughter, who sold it in 1950 to pay for the roof.</p>"
      f"<p>{_LONG}</p></article>", 1),
     ("<div>&copy; 2021 Songs and Sons</div>", 0)],
    [("<div class='nav'><p><a href=/aa>Home</a></p><p><a href=/ab>Letters</a></p></div>", 0),
     (f"<div><h1>Ferry</h1><p>{_LONG} {_MID}</p><p>{_SHORT}</p><p>{_MID}</p><p>No.</p><p>{_LONG} {_LONG}</p><p>{_SHORT}</p>"
      f"<p>{_MID}</p><p>{_LONG}</p></div>", 1),
     ("<div><p>(c) 2018 Ferry Post</p></div><div><a href=/ac>Top</a></div>", 0)],
    [("<nav><a href=/ad>Home</a></nav>", 0), (f"<article><h1>Ice</h1><p>{_LONG}</p><p>{_SHORT}</p><p>{_MID}</p></article>", 1)],
    [("<nav><a href=/ae>Home</a></nav><div>&copy; 2017 The Lake Paper, all rights reserved.</div>", 0),
     (f"<article><p>{_MID}</p><p>{_LONG}</p><p>{_SHORT}</p></article>", 1)],
    [("<div class='menu'><a href=/af>Home</a></div>", 0), (f"<main><p>{_LONG}</p><p>Yes.</p></main>", 1)],
    [(f"<article class='ad-free story'><p>{_LONG}</p><p>{_LONG}</p></article>", 1)],
    [(f"<div class='entry search-result'><p>{_LONG} {_LONG}</p></div>", 1)],
    [(f"<article><p>{_LONG}</p><p>All rights reserved.</p><p>{_MID}</p><p>Copyright 1931, says the cover.</p><p>{_LONG}</p>"
      "<p>All rights reserved.</p></article>", 1), ("<footer>Page 2</footer>", 0)],
    [(f"<article><p>{_SHORT}</p></article>", 1)],
    [(f"<main>{_MID}</main>", 1)],
    [(f"<p>{_LONG}</p>", 1)],
    [(f"{_LONG} {_MID} {_LONG}", 1)],
    [(_MID, 1)],
]


def plain(fragment: str) -> str:
    """The fragment with elements that name nothing: no attributes but links, no element of HTML 5."""
    bare = re.sub(r"<(/?)(?:nav|header|footer|aside|main|article|section|form|button)\b", r"<\1div", fragment)
    return re.sub(r"\s(?:class|id|role)='[^']*'", "", bare)


def told_by_words(fragment: str, label: int | None) -> bool:
    """False for what its names alone mark: boilerplate that is long and without links, as a
    reader's comment is, and a link that is part of the article."""
    if label == 1:
        return re.sub(r"<a .*?</a>|<[^>]*>", "", fragment).strip() != ""
    return label is None or "<a " in fragment or len(re.sub(r"<[^>]*>", " ", fragment).split()) <= 12


PAGES += [[(plain(fragment), label) for fragment, label in page if told_by_words(fragment, label)] for page in PAGES]
