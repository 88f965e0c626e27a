"""Labelled pages that the tree of `pages` is grown from.

A block of text that begins with the sign KEEP belongs to the main text, the others do not.
The sign stands at the first word, so it changes no count. The pages are written for this
purpose after common layouts; short texts also stand within each of the frames.
"""

from __future__ import annotations

KEEP = "¶"

PAGES = (
    # News with named parts.
    """<header><div>The Harbour Post</div><p>News of the coast since the old days</p></header>
    <nav><ul><li><a href=/>Home</a></li><li><a href=/t>Town</a></li><li><a href=/s>Sport and games</a></li></ul></nav>
    <article><h1>¶Ferry returns to the northern islands</h1><p>¶By our reporter</p>
    <p>¶The ferry that was taken out of service in spring will run again from Monday, the harbour office said, with
    two crossings in the morning and one at night.</p><p>¶Read <a href=/f>the full timetable</a> before you travel.</p>
    <h2>¶What changes</h2><p>¶Cars have to be booked a day before. Bicycles travel free of charge until the end of the year.</p>
    <p>¶Fares stay as they are.</p></article>
    <aside><h3>Most read</h3><ul><li><a href=/1>Storm takes roof off school</a></li><li><a href=/2>Choir sings again</a></li></ul></aside>
    <section id=comments><h3>2 comments</h3><p>Finally! I had to drive around the whole bay all summer to see my mother there.</p>
    <p>Good news.</p></section><footer><a href=/i>Imprint</a><p>Copyright The Harbour Post, all rights reserved.</p></footer>""",
    # A blog of named divs.
    """<div class=cookie-banner><p>We use cookies to make this page better for you.</p><a href=/c>More</a></div>
    <div class=navbar><a href=/>Start</a> <a href=/about>About me</a> <a href=/feed>Feed</a></div>
    <div class=post-content><h1>¶Baking without an oven</h1><p>¶Last winter our oven broke, and for three months I had
    nothing but a pan with a heavy lid. It turned out that this is enough for most kinds of bread.</p><h2>¶The dough</h2>
    <ul><li>¶Flour, 500 grams</li><li>¶Water, a large cup</li><li>¶Salt</li></ul><p>¶Mix, wait, fold, and wait again.</p>
    <p>¶I wrote about <a href=/y>keeping yeast alive</a> earlier.</p></div><div class=related-posts><h3>You may also like</h3>
    <p><a href=/a>Soup from the garden</a></p><p><a href=/b>Five pans</a></p></div>
    <div class=newsletter><p>Sign up and get a letter from me every month, with recipes that are not on this page.</p></div>""",
    # An article between lists of links, nothing named.
    """<div><a href=/>Home</a></div><div><a href=/p>Projects</a></div><div><a href=/k>Contact</a></div>
    <div><h1>¶How the bridge was moved</h1><p>¶Bridges are seldom moved, but this one has now been moved three times in its
    life, each time by a few hundred metres and each time at night.</p><p>¶The first move took a single week.</p>
    <p>¶For the second, engineers from <a href=/d>two countries</a> worked together on a plan that nobody had tried before,
    and they needed most of a year.</p><p>¶It still stands.</p></div>
    <div><a href=/1>Older text</a></div><div><a href=/2>Newer text</a></div><div>All rights reserved</div>""",
    """<div><a href=/>Start</a> <a href=/n>News</a> <a href=/m>Members only</a></div><h2>¶Summer walk</h2>
    <p>¶We meet at the old mill at eight and walk along the river as far as the lock, where lunch is served to all who booked it.</p>
    <p>¶Bring water.</p><p><a href=/x>Back to the list</a></p><p>Page 3 of 9</p>""",
    """<div><a href=/>Index</a></div><p>¶The archive holds letters, maps and account books from four centuries and can be used
    by anybody who asks a week before.</p><p>¶Copies cost a little.</p><p>¶Opening hours are posted at the door and may change
    when the reading room is needed for lectures.</p><div><a href=/t>Terms</a></div><div><a href=/j>Jobs</a></div>""",
    # Tables as frames, as on old pages.
    """<table><tr><td><a href=a>Main</a></td><td><a href=b>Photos of birds</a></td><td><a href=c>Links</a></td></tr></table>
    <table><tr><td><h1>¶Birds of our lake</h1><p>¶More than sixty kinds of birds breed here or rest on their way to the south,
    and most can be seen from the wooden tower.</p><p>¶Herons come first.</p><p>¶Please keep to the paths in spring, when the
    young ones leave their nests and cannot fly yet.</p></td></tr></table>
    <table><tr><td><a href=g>Guestbook</a></td><td>Visitors so far</td><td><a href=m>Mail</a></td></tr></table>""",
    # Documentation with steps.
    """<nav><a href=/>Docs</a><ul><li><a href=/i>Install</a></li><li><a href=/u>Use</a></li></ul></nav><main><h1>¶Install</h1>
    <p>¶You need a recent system and some space on the disk.</p><h2>¶Steps</h2><ol><li>¶Download the file</li><li>¶Unpack it</li>
    <li>¶Run <a href=/r>the first command</a></li></ol><p>¶If it fails, look at the log that is written to the folder you started
    in, and send it to us.</p></main><footer><p>Was this page helpful? Tell us what was missing.</p><a href=/e>Edit this page</a></footer>""",
    # A portal page: teasers are links, one text is not.
    """<div><a href=/>Portal</a></div><h3>Today</h3><ul><li><a href=/1>Market opens under new roof after long works</a></li>
    <li><a href=/2>Train line closed</a></li><li><a href=/3>Ten tips for the garden in autumn</a></li></ul>
    <h2>¶Word of the day</h2><p>¶A lintel is the beam above a door or a window that carries the wall over the opening.</p>
    <h3>Services</h3><ul><li><a href=/4>Weather</a></li><li><a href=/5>Jobs in town</a></li></ul><p>Version 4</p>""",
    # Much linked prose.
    """<div><a href=/>Main page</a></div><div><a href=/r>Random page</a></div><h1>¶Salt road</h1>
    <p>¶A <a href=/s>salt road</a> is any of the <a href=/t>trade routes</a> by which <a href=/x>salt</a> was carried to regions
    that lacked it, often over <a href=/m>mountains</a>.</p><h2>¶History</h2><p>¶The oldest known ones are from the
    <a href=/b>bronze age</a>.</p><p>¶Later ones had inns, <a href=/to>tolls</a> and guards along their way, and some of them
    became roads that are in use today.</p><h2>See also</h2><ul><li><a href=/1>Silk road</a></li><li><a href=/2>Amber road</a></li></ul>
    <div><a href=/c>Categories of this page</a></div><div>Last changed in May</div>""",
    # Questions, with remarks of readers.
    """<div class=header><a href=/>Ask</a></div><div class=content><h1>¶Why does my door stick?</h1><p>¶It is worst in summer,
    and I have already planed it twice.</p><p>¶Wood takes up water from the air, so it grows across its grain. Wait for a dry
    week, then seal all edges, the lower one as well.</p></div><div class=comment-list><p>Thanks, that worked for me as well
    after I had sealed the lower edge.</p><p>Same here.</p></div><div class=share><a href=/f>Send to a friend</a></div>""",
    # A press text with a shop's frame.
    """<div class=topbar><p>Free delivery over 50</p></div><div><a href=/w>Women</a></div><div><a href=/m>Men</a></div>
    <main><p>¶Press text, 4 March</p><h1>¶New workshop opens</h1><p>¶From April on, all shoes are repaired in our own workshop,
    in which twelve people find work.</p><p>¶Contact: Mara Lind</p></main><div class=ad><p>Two pairs for the price of one, only
    this week and only in this shop.</p></div><div><a href=/h>Help</a></div><div>Prices with tax</div>""",
    # Only links: no text.
    "<div><a href=/>Home</a></div><ul><li><a href=/a>First album</a></li><li><a href=/b>Second album</a></li></ul><div>Next</div><div><a href=/c>Up</a></div>",
    # A story of long and short paragraphs, links before and behind.
    """<ul><li><a href=/>Stories</a></li><li><a href=/a>Writers</a></li></ul><h1>¶The clock</h1><p>¶by R. Hall</p><p>¶When the clock
    in the tower stopped, nobody in the village noticed for two days, because everybody had a watch by then.</p><p>¶Only the
    baker did.</p><p>¶He had set his oven by it for forty years, and on the third day the bread was late.</p><p>¶"It stopped,"
    he said.</p><p>¶They mended it that same afternoon, all together, and nobody ever said who had paid for the new spring.</p>
    <p>¶The end</p><ul><li><a href=/n>Next story</a></li><li><a href=/p>Print</a></li></ul>""",
)

#: Texts without a frame.
TEXTS = (
    "<h1>¶Minutes</h1><p>¶The meeting was opened at nine by the chair, who welcomed the two new members.</p><p>¶The budget was passed.</p><p>¶No further points.</p>",
    "<p>¶One two three.</p>",
    "<p>¶Closed on Monday.</p><p>¶We are back on Tuesday.</p>",
    "<h1>¶Notice</h1><p>¶The pool stays shut.</p>",
    "<h1>¶Evening</h1><p>¶The light goes down</p><p>¶behind the last hill</p><p>¶and nobody calls</p><p>¶the dogs</p>",
    "<div><p>¶Moved to a new address.</p></div>",
    "<p>¶Sold out.</p><p>¶Come back soon.</p>",
    "<p>¶Thanks.</p><p>¶All went well.</p><p>¶See you soon.</p>",
    "<p>¶Dear all,</p><p>¶thank you for the many cards and calls of the last weeks, they helped us more than we can say.</p><p>¶Anna and Tom</p>",
    "<p>¶The whole story is told in a letter that the captain wrote to his sister before he left the port.</p><p>¶It was found in 1920.</p>",
)

#: Texts in which only the elements around tell the links from a menu.
LINKED = (
    """<h1>¶Sources</h1><p>¶All figures of this page are taken from the reports below, each of them with its year.</p>
    <ul><li><a href=/1>¶Harbour report, first part</a></li><li><a href=/2>¶Harbour report, second part</a></li><li>¶Letters</li></ul>""",
    "<p>¶We wrote about it.</p><p><a href=/w>¶The letter in full</a></p><p><a href=/v>¶The answer</a></p><p>¶More will follow.</p>",
    "<h2><a href=/t>¶The road north</a></h2><p>¶It is closed from today.</p><p><a href=/m>¶Map</a></p>",
    "<h1>¶Reading</h1><h2>¶Books on the road</h2><ul><li><a href=/b>¶Salt and iron</a></li></ul><h2>¶Maps</h2><p><a href=/m>¶The lake</a></p>",
)


def between_links(words: int) -> str:
    """A text of lines of so many words, with links before and after them."""
    line = "¶" + " ".join(["word"] * words)
    link = "<p><a href=/l>¶Of the same kind</a></p>"
    return f"<h1>{line}</h1>{link}<p>{line}</p>{link}<h2>{line}</h2>{link}<p>{line}</p>"


LINKED += tuple(between_links(words) for words in (1, 3, 6, 9, 12, 16, 25, 60))


def among_menus(words: int, item: str) -> tuple[str, ...]:
    """Pages of one line of text, or of two, with nothing named."""
    line = "¶" + " ".join(["word"] * words)
    menu = f"<div><a href=/>Home</a></div><div><a href=/m>{item}</a></div>"
    last = f"<p>{line}</p><p>¶It is.</p>"
    return f"{menu}<p>{line}</p>", f"{menu}<p>{line}</p>{menu}", f"{menu}<p>{line}</p>{last}{menu}<div>Page 2</div>", f"{menu}{last}"


ITEMS = ("Up", "News today", "More of this page", "All that was written here until today", "A list of all the pages that are kept in this archive")
LONE = tuple(page for item in ITEMS for words in (8, 12, 16, 25, 70) for page in among_menus(words, item))

#: What stands around a text.
FRAMES = (
    "<nav><a href=/>Start</a></nav><article>%s</article>",
    "<p><a href=/>Start</a></p><main>%s</main>",
    """<header><a href=/>Site</a></header><nav><a href=/a>One</a> <a href=/b>Two</a></nav><article>%s</article>
    <footer><a href=/i>Imprint</a></footer>""",
    """<ul><li><a href=/>Home</a></li><li><a href=/l>Last week</a></li></ul><main>%s</main>
    <aside><p>Written beside the text and of no use to it</p><ul><li><a href=/o>Other pages</a></li></ul></aside><footer>Made with care</footer>""",
    """<div class=sidebar><a href=/x>Archive</a><p>I live by the sea and write about what I find there.</p></div>
    <div class=entry-content>%s</div><div class=tags><a href=/s>sea</a></div><div class=comments><p>So true!</p></div>""",
)

SAMPLES = PAGES + TEXTS + LONE + tuple(frame % text for frame in FRAMES for text in TEXTS + LINKED)
