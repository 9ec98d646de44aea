"""Pages of layouts that the labeller's training pages do not copy, with their main text; written before the first run on them."""

SAID = "The harbour was closed on Monday after a storm damaged two of its piers and several boats."

LAYOUTS = {
    "recipe": (
        "<header><a href='/'>Kitchen notes</a></header><main><h1>Bread rolls</h1><p>A plain dough that needs one night of rest.</p><h2>Ingredients</h2><ul><li>500 g flour</li><li>300 ml water</li><li>2 teaspoons of salt</li><li>7 g yeast</li></ul>"
        "<h2>Method</h2><ol><li>Mix.</li><li>Knead for ten minutes.</li><li>Rest.</li></ol><table><tr><th>Energy</th><td>250 kcal</td></tr><tr><th>Fat</th><td>3 g</td></tr></table></main><footer>All rights reserved</footer>",
        ["Bread rolls", "A plain dough that needs one night of rest.", "Ingredients", "500 g flour", "300 ml water", "2 teaspoons of salt", "7 g yeast", "Method", "Mix.", "Knead for ten minutes.", "Rest.", "Energy", "250 kcal", "Fat", "3 g"],
    ),
    "table": (
        f"<nav><a href='/'>Start</a> <a href='/all'>All reports</a></nav><article><h1>Traffic by region</h1><p>{SAID}</p><table><tr><th>Region</th><th>Cars</th></tr><tr><td>North</td><td>120</td></tr><tr><td>South</td><td>95</td></tr></table></article>",
        ["Traffic by region", SAID, "Region", "Cars", "North", "120", "South", "95"],
    ),
    "german": (
        "<div><a href='/'>Startseite</a> <a href='/p'>Politik</a> <a href='/s'>Sport</a></div><div><h1>Der Hafen bleibt geschlossen</h1><p>Nach dem Sturm am Montag sind zwei Stege und mehrere Boote beschädigt.</p><p>Die Arbeiten dauern drei Wochen.</p></div><div>Datenschutz | Impressum</div>",
        ["Der Hafen bleibt geschlossen", "Nach dem Sturm am Montag sind zwei Stege und mehrere Boote beschädigt.", "Die Arbeiten dauern drei Wochen."],
    ),
    "town": (
        f"<div>This website stores data such as cookies.</div><div><h1>Storm closes the harbour</h1><p>{SAID}</p><p>Repairs take three weeks.</p></div><div>Copyright 2020 Town Herald</div>",
        ["Storm closes the harbour", SAID, "Repairs take three weeks."],
    ),
    "french": (
        "<section><p>Ce site utilise des cookies. Accepter</p></section><section><h2>Le port reste fermé</h2><p>Après la tempête de lundi, deux quais et plusieurs bateaux sont endommagés.</p></section><section><p>Mentions légales</p><p>Tous droits réservés</p></section>",
        ["Le port reste fermé", "Après la tempête de lundi, deux quais et plusieurs bateaux sont endommagés."],
    ),
    "spanish": (
        "<ul><li><a href='/'>Inicio</a></li><li><a href='/n'>Noticias</a></li></ul><main><h1>El puerto sigue cerrado</h1><p>La tormenta del lunes dañó dos muelles y varios barcos.</p></main><div>Todos los derechos reservados</div>",
        ["El puerto sigue cerrado", "La tormenta del lunes dañó dos muelles y varios barcos."],
    ),
    "glossary": (
        "<div id='top'><span>Search</span></div><div class='page'><h1>Terms of sailing</h1><dl><dt>Bow</dt><dd>The front of a boat.</dd><dt>Stern</dt><dd>The back of a boat.</dd><dt>Port</dt><dd>Left.</dd></dl></div><aside><h3>Popular posts</h3><a href='/k'>Knots</a></aside>",
        ["Terms of sailing", "Bow", "The front of a boat.", "Stern", "The back of a boat.", "Port", "Left."],
    ),
    "manual": (
        "<div class='sidebar'><ul><li><a href='/i'>Install</a></li><li><a href='/u'>Use</a></li></ul></div><div class='doc'><h1>Install</h1><p>Run this command first.</p><pre>make install</pre><ol><li>Open a shell.</li><li>Type it.</li></ol></div><div class='footer'>Powered by pages</div>",
        ["Install", "Run this command first.", "make install", "Open a shell.", "Type it."],
    ),
    "poem": (
        "<header><h2>Verses</h2></header><article><h1>Sea</h1><p>Grey sea,<br>old wind,<br>no sail.</p><p>Cold stone.</p></article><section class='comments'><h3>2 comments</h3><p>Great post!</p><p>Anna says: thanks for sharing</p></section>",
        ["Sea", "Grey sea, old wind, no sail.", "Cold stone."],
    ),
    "gallery": (
        f"<div class='ad'>Buy now</div><main><h1>After the storm</h1><figure><img src='a'><figcaption>A pier</figcaption></figure><figure><img src='b'><figcaption>Boats ashore</figcaption></figure><p>{SAID}</p></main><div class='share'>Share Tweet</div>",
        ["After the storm", "A pier", "Boats ashore", SAID],
    ),
}
