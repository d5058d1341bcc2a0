"""Word lists and name dictionaries of the headline pipeline, and what follows from them by rule."""

from __future__ import annotations

import unicodedata

# Stop words.
STOPWORDS = frozenset("""
el la los las un una unos unas y o pero que en a de del al por para con sin sobre entre hasta desde
su sus se lo le como más menos muy este esta estos estas ese esa eso aquél aquella
qué cuál cómo cuándo dónde quién cuánto ser es son fue fueron ha han hay está están
también solo sólo después antes durante tras según contra mediante excepto hacia
no ni nos nosotros ante bajo años año mes meses día días hora horas
mil nuevo nueva nuevos nuevas dos tres uno cuatro cinco seis siete ocho nueve diez ciento cientos
primera primero primer segunda segundo tercera tercero cuarta quinto
otro otra otros otras mismo misma mismos mismas todo toda todos todas algo alguno alguna algunos algunas
cada cual cuales cualquier cualesquiera puede pueden poder debe deben deber
sido estado será serán había habían habrá habrán revisa cable aquí tiene pide así
anuncia anuncian anuncio confirma confirman confirmó revela revelan informa informan asegura aseguran
advierte advierten destaca destacan señala señalan indica indican reporta reportan denuncia denuncian
explica explican afirma afirman sostiene sostienen dice dicen declara declaran califica considera
quot amp lt gt nbsp mdash ndash rsquo lsquo hellip
""".split())

# Canonical names of several words, in order of precedence.
NAMES = """
Colo Colo|Bío Bío|Estados Unidos|Reino Unido|Nueva Zelanda|Costa Rica|Puerto Rico|San Marino|Corea del Sur|Corea del Norte
Emiratos Árabes|Arabia Saudita|Guinea Ecuatorial|Sierra Leona|Burkina Faso|Cabo Verde|Timor Oriental|Sri Lanka|Papúa Nueva
Nueva Guinea|América Latina|Medio Oriente|Naciones Unidas|Ciudad del Vaticano|Hong Kong|Casa Blanca|Banco Central
Fuerzas Armadas|Derechos Humanos|Cruz Roja|Unión Europea|Primera Guerra|Segunda Guerra|Guerra Mundial|Poder Judicial
Tribunal Constitucional|Cámara de Diputados|Presidente de la República|José Antonio Kast|Gabriel Boric|Sebastián Piñera
Michelle Bachelet|Camila Vallejo|Carolina Tohá|Evelyn Matthei|Mario Desbordes|Giorgio Jackson|Rodrigo Valdés|Daniel Jadue
Yasna Provoste|Heraldo Muñoz|Felipe Kast|Mario Marcel|Johannes Kaiser|Rodolfo Carter|Jeannette Jara|Gonzalo Winter
Paulina Vodanovic|Tomás Vodanovic|Claudio Orrego|Isabel Allende|Lula da Silva|Emmanuel Macron|Giorgia Meloni
Benjamin Netanyahu|Ursula von der Leyen|Nayib Bukele|Nicolás Maduro|Delcy Rodríguez|Elon Musk|Democracia Cristiana
Renovación Nacional|Unión Demócrata Independiente|Partido Comunista|Partido Socialista|Partido Por la Democracia
Partido Republicano|Partido Liberal|Partido Radical|Partido de la Gente|Frente Amplio|Convergencia Social
Revolución Democrática|Acción Humanista|Chile Vamos|Apruebo Dignidad|Donald Trump|Joe Biden|Vladimir Putin|Xi Jinping
Corte Suprema|Ministerio Público|Carabineros de Chile|Fiscalía Nacional|Contraloría General|Banco Estado|Copa América
Copa Libertadores|Universidad de Chile|Ministerio del Interior|Ministerio de Defensa|Ministerio de Hacienda
Ministerio de Economía|Ministerio de Educación|Ministerio de Justicia|Ministerio del Trabajo|Ministerio de Salud
Ministerio de Vivienda|Ministerio de Agricultura|Ministerio de Minería|Ministerio de Transporte|Ministerio de Energía
Ministerio de Deportes|Ministerio de la Mujer|Ministerio de Ciencia|Ministerio de Obras Públicas
Ministerio del Medio Ambiente|Ministerio de Relaciones Exteriores|Ministerio de Desarrollo Social|San Antonio|San Bernardo
San Carlos|San Clemente|San Cristóbal|San Esteban|San Fabián|San Felipe|San Fernando|San Francisco|San Ignacio|San Javier
San Joaquín|San José|San Juan|San Miguel|San Nicolás|San Pablo|San Pedro|San Rafael|San Ramón|San Rosendo|San Vicente
Santa Bárbara|Santa Cruz|Santa Juana|Santa María|Santa Rosa|Santo Domingo
""".strip().replace("\n", "|").split("|")

# Names that the pairs profile lacks, and patterns that don't follow from the name by the rule below.
NOT_IN_PAIRS = frozenset(["Ministerio Público", "Carabineros de Chile"])
OWN_PATTERNS = {
    "Ursula von der Leyen": ["von der leyen"],
    "Lula da Silva": ["lula da silva", "lula silva"],
    "Arabia Saudita": ["arabia saudita", "arabia saudí"],
    "Sebastián Piñera": ["sebastián piñera", "sebastian pinera", "sebastian piñera"],
    "Bío Bío": ["bío bío", "bio bio", "bio bío", "bío bio"],
}
LINKS = frozenset("de del la por".split())

# Names whose hyphenated spelling is known.
HYPHENATED = """
Estados Unidos|Reino Unido|Nueva Zelanda|Costa Rica|Puerto Rico|Corea del Sur|Corea del Norte|Emiratos Árabes|Arabia Saudita
Guinea Ecuatorial|Sierra Leona|Burkina Faso|Cabo Verde|Timor Oriental|Sri Lanka|Papúa Nueva|Nueva Guinea|América Latina
Medio Oriente|Naciones Unidas|Hong Kong|Casa Blanca|Banco Central|Fuerzas Armadas|Derechos Humanos|Cruz Roja|Unión Europea
San Marino|Poder Judicial|Tribunal Constitucional|Colo Colo|Bío Bío|San Antonio|San Bernardo|San Carlos|San Clemente
San Cristóbal|San Esteban|San Fabián|San Felipe|San Fernando|San Francisco|San Ignacio|San Javier|San Joaquín|San José|San Juan
San Miguel|San Nicolás|San Pablo|San Pedro|San Rafael|San Ramón|San Rosendo|San Vicente|Santa Bárbara|Santa Cruz|Santa Juana
Santa María|Santa Rosa|Santo Domingo|Democracia Cristiana|Renovación Nacional|Frente Amplio|Partido Comunista
Partido Socialista|Partido Republicano|Chile Vamos|Apruebo Dignidad|Convergencia Social
""".strip().replace("\n", "|").split("|")

# Single words and the name they stand for.
SINGLES = {
    "boric": "Gabriel Boric", "piñera": "Sebastián Piñera", "pinera": "Sebastián Piñera", "bachelet": "Michelle Bachelet",
    "matthei": "Evelyn Matthei", "provoste": "Yasna Provoste", "desbordes": "Mario Desbordes", "jadue": "Daniel Jadue",
    "tohá": "Carolina Tohá", "toha": "Carolina Tohá", "vallejo": "Camila Vallejo", "kast": "José Antonio Kast", "trump": "Donald Trump",
    "biden": "Joe Biden", "putin": "Vladimir Putin", "zelenski": "Volodimir Zelenski", "zelensky": "Volodimir Zelenski",
    "milei": "Javier Milei", "bolsonaro": "Jair Bolsonaro", "lula": "Lula da Silva", "marcel": "Mario Marcel", "kaiser": "Johannes Kaiser",
    "carter": "Rodolfo Carter", "orrego": "Claudio Orrego", "bukele": "Nayib Bukele", "macron": "Emmanuel Macron",
    "meloni": "Giorgia Meloni", "netanyahu": "Benjamin Netanyahu", "maduro": "Nicolás Maduro", "musk": "Elon Musk",
    "udi": "Unión Demócrata Independiente", "ppd": "Partido Por la Democracia", "pdc": "Democracia Cristiana",
    "evópoli": "Evolución Política", "evopoli": "Evolución Política",
}

# Forms of a word and their lemma.
LEMMAS = {
    "delincuente": "delincuencia", "delincuentes": "delincuencia", "criminal": "crimen", "criminales": "crimen", "corrupto": "corrupción",
    "corruptos": "corrupción", "corrupta": "corrupción", "corruptas": "corrupción", "migrante": "migración", "migrantes": "migración",
    "migratorio": "migración", "migratoria": "migración", "económico": "economía", "económica": "economía", "económicos": "economía",
    "económicas": "economía", "manifestante": "manifestación", "manifestantes": "manifestación", "protestas": "protesta",
    "constituyente": "constitución", "constituyentes": "constitución", "constitucional": "constitución", "pensionado": "pensión",
    "pensionados": "pensión", "pensionada": "pensión", "pensionadas": "pensión", "violento": "violencia", "violenta": "violencia",
    "violentos": "violencia", "violentas": "violencia", "elecciones": "elección", "electoral": "elección", "electorales": "elección",
    "sanitario": "salud", "sanitaria": "salud", "sanitarios": "salud", "sanitarias": "salud", "educativo": "educación",
    "educativa": "educación", "educativos": "educación", "educativas": "educación", "terremoto": "sismo", "terremotos": "sismo",
    "sismos": "sismo",
}

# Words that are left out of bodies.
JUNK = frozenset("""
aaa aba aaisa aap aas sd hd jpg like new child https length http domcontentloaded flexdirection firstdiv pointer addeventlistener
queryselector marginbottom containers lastdiv foreach innerwidth right left top align gnews px twitter com pic font height width
pred fs us april flickr datawrapper data fried ftx medium exante server family loc lon mag prof lat gpt banner donación style
relacionadasdetalle null containerstyleflexdirection firstdivstylemarginbottom first div formstyleflexdirection formulario flex
last cursor document deventlistenerdomloedevent query selector all responsive firstchild tablaennotici notatablaemol public demr
detalleicon important tdnthchildn arial updatelayout function transmision fontsize backgroundcolor display padding lineheight
ifslength kok queryselectorall queryselectorinputtyp elements submit www ficon alignitems margin sans serif aton emolmlt border
rectangle container img end weight content rem bottom center radius text síguenos solid items dadada droidsans justify push cmd
googletag ad protected email aach aafp aafdf
""".split())

# Sources and the names by which they are shown.
SOURCE_LABELS = {
    "24horas": "24 Horas", "adnradio": "ADN Radio", "agricultura": "Agricultura", "biobio": "Radio BíoBío", "chvnoticias": "CHV Noticias",
    "ciper": "Ciper", "cnnchile": "CNN Chile", "cooperativa": "Cooperativa", "diariofinanciero": "D. Financiero", "elciudadano": "El Ciudadano",
    "eldinamo": "El Dínamo", "elmostrador": "El Mostrador", "elsiglo": "El Siglo", "emol": "Emol", "exante": "Ex-Ante", "lacuarta": "La Cuarta",
    "lahora": "La Hora", "lanacion": "La Nación", "latercera": "La Tercera", "meganoticias": "Meganoticias", "publimetro": "Publimetro",
    "radiouchile": "Radio U. de Ch.", "t13": "T13", "theclinic": "The Clinic", "redgol": "RedGol", "lasegunda": "La Segunda",
    "eldesconcierto": "El Desconcierto", "quintopoder": "El Quinto Poder", "izquierdadiario": "La Izquierda Diario",
}

# Month names, in order.
MONTHS = "enero febrero marzo abril mayo junio julio agosto septiembre octubre noviembre diciembre".split()
TONES = ("positivo", "neutral", "negativo")


def unaccented(text: str) -> str:
    return "".join(c for c in unicodedata.normalize("NFD", text) if not unicodedata.combining(c))


def _patterns(name: str) -> list[tuple[str, ...]]:
    own = OWN_PATTERNS.get(name)
    if own is None:
        plain = " ".join(w for w in name.lower().split() if w not in LINKS)
        own = list(dict.fromkeys([plain, unaccented(plain)]))
    return [tuple(x.split()) for x in own]


def compounds(pairs: bool = False) -> dict[tuple[str, ...], str]:
    """Pattern of two or three words -> canonical name, in order of precedence."""
    return {p: name for name in NAMES if not (pairs and name in NOT_IN_PAIRS) for p in _patterns(name)}


def hyphens() -> dict[str, str]:
    """Hyphenated spelling, with and without accents -> canonical name."""
    out = {form.lower().replace(" ", "-"): name for name in HYPHENATED for form in (name, unaccented(name))}
    return out | {"ciudad-vaticano": "Ciudad del Vaticano"}


def singles() -> dict[str, str]:
    return dict(SINGLES)


def lemmas() -> dict[str, str]:
    return dict(LEMMAS)


def variants(word: str) -> list[str]:
    """A canonical word and all its forms (the inverse of the lemma map)."""
    return [word, *(form for form, lemma in LEMMAS.items() if lemma == word)]


def singular(word: str) -> str:
    """A word without its Spanish plural, by its ending."""
    for ending, least, instead in (("ces", 5, "z"), ("es", 5, ""), ("s", 4, "")):
        if word.endswith(ending) and len(word) >= least:
            return word[: len(word) - len(ending)] + instead
    return word


def fuse(tokens: list[str], by_first: dict[str, tuple[dict, dict]]) -> list[str]:
    """Greedy fusion from left to right: at each place a pattern of three words, else of two, else the word."""
    out, i, n = [], 0, len(tokens)
    while i < n:
        two, three = by_first.get(tokens[i], ({}, {}))
        if three and i + 2 < n and (name := three.get((tokens[i + 1], tokens[i + 2]))):
            i += 3
        elif two and i + 1 < n and (name := two.get((tokens[i + 1],))):
            i += 2
        else:
            name = tokens[i]
            i += 1
        out.append(name)
    return out


def first_words(patterns: dict[tuple[str, ...], str]) -> dict[str, tuple[dict, dict]]:
    """Patterns by first word: ({rest of two words: name}, {rest of three words: name}), the first of equals kept."""
    out: dict[str, tuple[dict, dict]] = {}
    for p, name in patterns.items():
        if len(p) in (2, 3):
            out.setdefault(p[0], ({}, {}))[len(p) - 2].setdefault(p[1:], name)
    return out

