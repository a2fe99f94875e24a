"""Pages of layouts that the test tables lack, labelled by hand: lines that begin with + are the article."""

PAGES = (
    """<html><body><div class="topbar"><a href=/>Home</a> <a href=/news>News</a> <a href=/sport>Sport</a></div>
<div id="wrapper"><div class="story-body">
+<h1>Bridge over the river to close for repairs</h1>
+<p>The old road bridge will be closed to cars from Monday while engineers replace two of its bearings.</p>
+<p>Buses are going to be diverted through the town centre, the council said on Thursday.</p>
+<p>Work should take about six weeks if the weather holds.</p>
</div><div class="related-links"><h3>More on this</h3><ul><li><a href=/1>Bridge tolls to rise</a></li><li><a href=/2>Ferry returns</a></li></ul></div>
<div class="footer">Copyright 2024 The Valley Post. All rights reserved.</div></div></body></html>""",
    """<body><table width=100%><tr><td class="menu"><a href=a>Start</a><br><a href=b>Docs</a><br><a href=c>Contact</a></td><td class="content">
+<h2>Installing the pump</h2>
+<p>Switch the power off before you open the housing. Loosen the four screws at the back and lift the cover.</p>
+<ul><li>Put the seal into the groove.</li><li>Press the pump in until it clicks.</li></ul>
+<p>Close the housing again and turn the valve slowly.</p>
</td></tr><tr><td colspan=2 class="copyright">Pumps and Valves Ltd, 2019</td></tr></table></body>""",
    """<html><head><title>Blog</title><body><header><h1>Notes from the garden</h1><nav><a href=1>About</a> <a href=2>Archive</a></nav></header>
<main><div class="post">
+<h2>When to cut roses back</h2>
+<p>Most roses can be cut back as soon as the forsythia blooms, which here is the middle of March.</p>
+<blockquote>Cut to an outward bud, my grandmother used to say.</blockquote>
+<p>I leave climbing roses alone until they have flowered once.</p>
<div class="share">Share this on the networks</div></div>
<div id="comments"><h3>2 comments</h3><p class="comment">Lovely post, I do the same with my roses every year!</p><p class="comment">What about hydrangeas, do you cut those as well?</p></div></main>
<aside><h4>Tags</h4><a href=t>roses</a></aside><footer>Powered by a small engine</footer></body></html>""",
    """<div class="cookie-notice">We use cookies to improve this site. <button>Accept</button></div><div id="nav"><ul><li><a href=/>Home</a><li><a href=/r>Recipes</a></ul></div>
<section class="entry-content">
+<h1>Lentil soup</h1>
+<p>Fry the onion and the carrots in oil until they are soft, then add the lentils.</p>
+<ol><li>Pour in a litre of stock.</li><li>Simmer for half an hour.</li><li>Season with vinegar.</li></ol>
+<p>It tastes even better on the next day.</p>
</section><div class="newsletter"><p>Get a new recipe each week by mail.</p><form><input><button>Subscribe</button></form></div>
<div class="ad">Buy two pans for the price of one</div>""",
    """<body><div role="navigation"><a href=1>Guide</a><a href=2>Reference</a></div><div role="main">
+<h1>Time zones</h1>
+<p>A timestamp without a zone is read in the zone of the session, which is UTC unless set otherwise.</p>
+<pre>set zone = 'UTC'</pre>
+<p>Daylight saving makes some local times occur twice.</p>
</div><div role="contentinfo" class="footer"><a href=l>Licence</a> <a href=p>Privacy</a></div></body>""",
    """<body><article class="post"><header><nav class="breadcrumb"><a href=1>Home</a> / <a href=2>Science</a></nav></header>
+<h1>Why the sea is salty</h1>
+<p>Rivers carry small amounts of salt from the rocks into the sea, and it stays there when the water evaporates.</p>
+<figure><img src=x><figcaption>Salt pans on the coast.</figcaption></figure>
+<p>Vents on the sea floor add to it.</p>
<div class="promo"><p>Read our new magazine, now with forty more pages.</p></div>
+<p>In all, a litre of sea water holds about thirty-five grams.</p>
<div class="social"><a href=f>Like</a><a href=t>Post</a></div></article><footer>Imprint and terms of use</footer></body>""",
    """<div class="page"><div class="login-form"><form>Name <input> <button>Log in</button></form></div><div class="article-body">
+<h1>Council votes for new library</h1>
+<p>By eleven votes to four the council decided on Tuesday to build a new library next to the station.</p>
+<p>"It is a good day for readers," said the head of the committee.</p>
+<p>Building is to start next spring.</p>
</div><div class="sidebar"><h4>Most read</h4><ol><li><a href=1>Fire in the old mill</a></li><li><a href=2>School wins prize</a></li></ol></div>
<div id="footer"><p>Contact us at the news desk.</p></div></div>""",
    """<body><section id="content"><div class="entry">
+<h1>Chapter one</h1>
+<p>It had been raining since the morning and the road to the village was a stream.</p>
+<p>Nobody had seen the carrier, and nobody expected to.</p>
+<p>Only the dog kept looking down the hill.</p>
</div><div class="pager menu"><a href=p>Previous</a> <a href=n>Next</a></div></section><div class="banner"><p>Free shipping on all books this week.</p></div></body>""",
    """<html><body><div class="menu"><ul><li><a href=1>Products</a></li><li><a href=2>Support</a></li></ul></div><div class="main-content"><div class="post-content">
+<h1>Release 4.2</h1>
+<p>This release brings faster start-up and mends a leak in the cache.</p>
+<table><tr><th>Part</th><th>Change</th></tr><tr><td>Cache</td><td>Entries expire in time.</td></tr></table>
+<p>Users of version 3 should read the notes on moving first.</p>
</div></div><div class="comments-list"><div class="comment"><p>Works fine on my machine, thank you for the quick fix.</p></div></div>
<div class="popup modal"><p>Take part in our survey and win a prize.</p></div><div class="copyright">2023 Makers</div></body></html>""",
    """<body><div><div><a href=1>Front page</a> <a href=2>Politics</a> <a href=3>Weather</a></div><div>
+<h1>Storm moves east</h1>
+<p>The storm that crossed the islands on Sunday is moving east and losing strength, forecasters said.</p>
+<p>Gusts of a hundred kilometres an hour were measured on the coast in the night.</p>
+<p>Trains are running again.</p>
</div><div><a href=4>Terms</a> <a href=5>Privacy</a> <a href=6>Jobs</a></div></div></body>""",
)
