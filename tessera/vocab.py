"""Controlled vocabularies: fixed values of the domain, in scan order."""

from __future__ import annotations

#: Periods (key, label, start, end), years BCE negative.
PERIODS = (("HALLSTATT", "Hallstatt", -800, -450), ("LA_TENE", "La Tène", -450, -25), ("TRANSITION", "Hallstatt/La Tène", -500, -400))
UNKNOWN = "indéterminé"

#: Sub-periods (name, start, end), in order.
SUB_PERIODS = (
    ("Ha C", -800, -620), ("Ha D1", -620, -540), ("Ha D2", -540, -500), ("Ha D3", -500, -450),
    ("LT A", -450, -380), ("LT B1", -380, -320), ("LT B2", -320, -260), ("LT C1", -260, -200), ("LT C2", -200, -150), ("LT D1", -150, -80), ("LT D2", -80, -25),
    ("Ha D3 / LT A", -500, -400),
)

#: Sub-periods that a period admits.
ADMITTED = {
    "Hallstatt": ("Ha C", "Ha D", "Ha D1", "Ha D2", "Ha D3", "Ha D2-D3", "Ha D2/D3"),
    "La Tène": ("LT A", "LT B", "LT B1", "LT B2", "LT C", "LT C1", "LT C2", "LT D", "LT D1", "LT D2"),
    "Hallstatt/La Tène": ("Ha D3 / LT A", "Ha D3/LT A"),
}
PREFIXES = {"Hallstatt": ("Ha",), "La Tène": ("LT",), "Hallstatt/La Tène": ("Ha", "LT")}

#: Text patterns of each period, French then German.
PERIOD_PATTERNS = {
    "Hallstatt": (
        "Hallstatt", "hallstattien", "hallstattienne", "premier âge du Fer", "Premier âge du fer", "1er âge du Fer", "Ha C", "Ha D", "Hallstattzeit", "hallstattzeitlich",
        "ältere Eisenzeit", "Ältere Eisenzeit", "Frühhallstattzeit", "Späthallstattzeit",
    ),
    "La Tène": (
        "La Tène", "laténien", "laténienne", "second âge du Fer", "Second âge du fer", "2e âge du Fer", "2nd âge du Fer", "LT A", "LT B", "LT C", "LT D",
        "Latène", "Latènezeit", "jüngere Eisenzeit", "Jüngere Eisenzeit", "Frühlatènezeit", "Mittellatènezeit", "Spätlatènezeit",
    ),
    "Hallstatt/La Tène": ("transition Hallstatt-La Tène", "Ha D3/LT A", "charnière Ha/LT", "Übergang Hallstatt-Latène", "Hallstatt-Latène-Übergang"),
}
SUB_PERIOD_PATTERN = r"(?:Ha\s*[CD](?:\d)?(?:-[CD]?\d)?|LT\s*[A-D](?:\d)?)"

#: Site types and their aliases, French then German; a repeated alias keeps its first place and its last type.
TYPE_ALIASES = {
    "oppidum": ("oppidum", "fortification", "enceinte", "fortification de hauteur", "site fortifié", "site de hauteur", "éperon barré", "site perché", "refuge",
                "Oppidum", "Höhensiedlung", "Höhenburg", "Befestigung", "befestigte Höhensiedlung", "Ringwall", "Abschnittsbefestigung", "Burganlage"),
    "habitat": ("habitat", "habitat ouvert", "village", "établissement", "établissement rural", "ferme", "hameau", "occupation", "habitat groupé", "habitat dispersé", "fosse", "fossé",
                "fond de cabane", "structure d'habitat", "grenier", "silo", "Siedlung", "Gehöft", "Dorf", "offene Siedlung", "ländliche Siedlung", "Wohnplatz", "Grubenhütte", "Pfostenbau", "Speicher", "Vorratsgrube"),
    "nécropole": ("nécropole", "cimetière", "tombe", "sépulture", "inhumation", "incinération", "champ d'urnes", "ensemble funéraire", "tombe plate", "tombe à char", "tombe riche", "enclos funéraire",
                  "crémation", "urne", "Gräberfeld", "Nekropole", "Grab", "Bestattung", "Grabhügel", "Hügelgrab", "Urnenfeld", "Friedhof", "Flachgrab", "Wagengrab", "Fürstengrab", "Brandgrab", "Körpergrab", "Grabanlage"),
    "dépôt": ("dépôt", "trésor", "cachette", "dépôt votif", "dépôt métallique", "trouvaille isolée", "découverte isolée", "Hortfund", "Depotfund", "Schatzfund", "Verwahrfund", "Metalldepot", "Einzelfund", "Lesefund"),
    "sanctuaire": ("sanctuaire", "lieu de culte", "temple", "espace sacré", "enclos cultuel", "fanum", "Heiligtum", "Kultstätte", "Viereckschanze", "Tempel", "Kultplatz", "Opferplatz"),
    "atelier": ("atelier", "forge", "officine", "atelier métallurgique", "bas fourneau", "zone de production", "atelier de potier", "mine", "extraction",
                "Werkstatt", "Schmiede", "Verhüttungsplatz", "Produktionsstätte", "Rennofen", "Töpferofen", "Bergwerk"),
    "voie": ("voie", "chemin", "route", "passage", "gué", "pont", "Weg", "Straße", "Verkehrsweg", "Furt", "Altweg", "Brücke"),
    "tumulus": ("tumulus", "tertre", "butte", "tumulus funéraire", "tertre funéraire", "groupe de tumulus", "nécropole tumulaire", "Grabhügel", "Hügelgrab", "Tumulus", "Erdhügel", "Hügelgräberfeld"),
}

#: Canonical place names and their variants.
TOPONYMS = {
    "Strasbourg": ("Straßburg", "Strassburg", "Argentoratum"),
    "Colmar": ("Kolmar",),
    "Mulhouse": ("Mülhausen", "Mülhousen"),
    "Haguenau": ("Hagenau",),
    "Brumath": ("Brocomagus", "Braumath"),
    "Saverne": ("Zabern", "Tres Tabernae"),
    "Sélestat": ("Schlettstadt", "Schlestadt"),
    "Wissembourg": ("Weißenburg", "Weissenburg"),
    "Biesheim": ("Oedenburg", "Kunheim"),
    "Sainte-Croix-en-Plaine": ("Heiligkreuz",),
    "Obernai": ("Oberehnheim",),
    "Molsheim": ("Molzheim",),
    "Thann": ("Than",),
    "Altkirch": ("Altkirch",),
    "Ribeauvillé": ("Rappoltsweiler",),
    "Guebwiller": ("Gebweiler",),
    "Rouffach": ("Rufach",),
    "Ensisheim": ("Ensisheim",),
    "Erstein": ("Erstein",),
    "Benfeld": ("Benfeld",),
    "Marckolsheim": ("Markolsheim",),
    "Illkirch-Graffenstaden": ("Illkirch", "Graffenstaden"),
    "Schiltigheim": ("Schiltigheim",),
    "Lingolsheim": ("Lingolsheim",),
    "Mundolsheim": ("Mundolsheim",),
    "Soufflenheim": ("Suflenheim",),
    "Niederbronn-les-Bains": ("Niederbronn",),
    "Reichshoffen": ("Reichshofen",),
    "Wœrth": ("Wörth",),
    "Lauterbourg": ("Lauterburg",),
    "Kembs": ("Kembs", "Cambete"),
    "Sierentz": ("Sierenz",),
    "Breisach am Rhein": ("Vieux-Brisach", "Breisach", "Brisach", "Mont Isteiner Klotz"),
    "Basel": ("Bâle", "Basle", "Münsterhügel"),
    "Augst": ("Augusta Raurica", "Augst"),
    "Liestal": ("Liestal",),
    "Sissach": ("Sissach",),
    "Pratteln": ("Pratteln",),
    "Muttenz": ("Muttenz",),
    "Reinach": ("Reinach BL",),
    "Allschwil": ("Allschwil",),
}

#: Patterns of ages and datings, as the rules state them.
IRON_PATTERN = (
    r"\b(?:hallstatt|ha\s*[cd]\d?|la\s+tène|latène|lt\s*[a-d]\d?|"
    r"âge\s+du\s+fer|age\s+du\s+fer|eisenzeit|"
    r"premier\s+âge|second\s+âge|protohistor)\b"
)
OLDER_PATTERN = r"\b(?:âge\s+du\s+bronze|age\s+du\s+bronze|bronzezeit|" r"néolith|paléolith|mésol|chalcolith)\b"
DATE_PAIR_PATTERN = r"^(-?\d+):(-?\d+)$"
PERIOD_CODE_PATTERN = r"^EUR(FER|BRO|NEO|GAL|ROM|MED|MOD)[-]+$"
TEXTUAL_AGE_PATTERN = (
    r"[Aa]ge\s+du\s+(fer|bronze|Fer|Bronze)"
    r"(?:\s*[-–]\s*(?:[Aa]ge\s+du\s+)?(fer|bronze|Fer|Bronze|[Gg]allo[- ]?romain))?"
)
SUB_PERIOD_RANGE_PATTERN = r"(Ha|LT)\s*([A-D]\d?)\s*[-–/]\s*(?:(Ha|LT)\s*)?([A-D]\d?)"
SINGLE_SUB_PERIOD_PATTERN = r"(Ha|LT)\s*([A-D]\d?)"
RADIOCARBON_PATTERN = r"(\d+)\s*[-–]\s*(\d+)(?:\s*(?:avant|av\.?)\s*(?:J\.?-?C\.?)?)?"

#: sources' own vocabularies.
CHARACTER_TYPES = {
    "enceinte": "oppidum", "fortification": "oppidum", "funéraire": "nécropole", "habitat": "habitat", "groupé": "habitat", "dispersé": "habitat",
    "route/voie": "voie", "production": "atelier", "artisanat": "atelier", "cultuel": "sanctuaire", "dépôt": "dépôt",
}
MATERIALS = ("céramique", "métal", "lithique", "verre", "os", "terre cuite")
COUNTRY_CODES = {"f": "FR", "fr": "FR", "d": "DE", "de": "DE", "ch": "CH", "s": "CH"}
RICH_TYPES = {
    "tombe princière": "nécropole", "tombe princière ?": "nécropole", "tombe": "nécropole", "tombe à char": "nécropole", "nécropole": "nécropole", "habitat": "habitat",
    "habitat de hauteur": "habitat", "habitat fortifié": "oppidum", "site fortifié de hauteur": "oppidum", "site fortifié": "oppidum", "oppidum": "oppidum", "dépôt": "dépôt", "tumulus": "tumulus",
}
FLAG_COLUMNS = {"BF3_HaC": ("Ha C",), "HaD": ("Ha D",), "LTAB": ("LT A", "LT B"), "LTCD": ("LT C", "LT D")}
PARASITIC = r"(?i)^(?:TOTAL|Supprimé|Département|$)"
PARASITIC_DEPARTMENT = r"(?i)^(?:Manque|Total|$|\s*$)"
COMMENT_KEYS = ("GENAUIGK_T", "DAT_FEIN", "TYP_FEIN", "TYP_GROB", "DAT_GROB", "LISTENTEXT")
TERM_CATEGORIES = (
    ("funéraire", ("tombe", "tumulus", "nécropole", "sépulture", "inhumation", "crémation", "urne", "sarcophage", "squelette")),
    ("mobilier", ("fibule", "bracelet", "anneau", "épée", "lance", "céramique", "amphore", "vase", "perle", "monnaie", "hache", "couteau", "agrafe", "arme", "applique", "boucle", "clou", "aiguille")),
    ("structure", ("mur", "four", "fossé", "silo", "cave", "fosse", "puits", "fondation", "sol", "aire", "enclos", "palissade")),
    ("période", ("hallstatt", "tène", "bronze", "néolith", "romain", "méroving", "médiéval", "antiq")),
    ("matériau", ("bronze", "fer", "or", "argent", "verre", "os", "silex", "lignite", "ambre", "argile")),
    ("voirie", ("voie", "route", "chemin", "pont", "aqueduc", "borne")),
)
STRONG_TYPES = ("oppidum", "nécropole", "tumulus", "dépôt", "sanctuaire", "atelier")
TYPE_RANK = ("oppidum", "sanctuaire", "tumulus", "nécropole", "dépôt", "atelier", "habitat", "voie")
IRON_WORDING = (
    r"\bha\s*[abcd][0-9]?(?:\s*[-/]\s*[bcd][0-9]?)?", r"\blt\s*[abcd][0-9]?(?:\s*[-/]\s*[abcd][0-9]?)?", r"bze\s*d", r"bze\s*c\s*[-/]\s*d", r"bze\s*d\s*[-/]\s*ha", r"hallstatt", r"lat[eè]ne",
    r"charni[eè]re", r"transition\s+hallstatt", r"ha\s*d3\s*/\s*lt", r"âge\s+du\s+fer", r"age\s+du\s+fer",
)
OTHER_PERIODS = (
    ("BRONZE_FINAL", r"[Bb]ronze\s+final|BF\s*III"), ("NEOLITHIQUE", r"[Nn]éolith"), ("GALLO_ROMAIN", r"[Gg]allo[- ]?romain|[ée]poque\s+romaine|[Rr]omaine?\b"),
    ("MEROVINGIEN", r"[Mm]érovingi"), ("MEDIEVAL", r"[Mm]édiéval|[Mm]oyen\s+[âa]ge"),
)
SUB_PERIOD_WORDING = (
    (r"La\s+Tène\s*I\s*a?", "LT A"), (r"La\s+Tène\s*I\s*b", "LT B1"), (r"Hallstatt\s*C(?:\s*[-–/]\s*D\d?)?", "Ha C"), (r"Hallstatt\s*D\s*1|Hallstatt\s*moyen\s*I", "Ha D1"),
    (r"Hallstatt\s*D\s*2", "Ha D2"), (r"Hallstatt\s*D\s*3", "Ha D3"), (r"Hallstatt\s*D\b(?!\d)", "Ha D"),
)
PERIOD_CODES = {
    "EURFER": "Âge du Fer", "EURBRO": "Âge du Bronze", "EURGAL": "Gallo-romain", "EURNEO": "Néolithique", "EURMER": "Mérovingien", "EURMED": "Médiéval", "EURMOD": "Moderne", "EURPAL": "Paléolithique", "EURMES": "Mésolithique",
}
CODE_PAIRS = {
    ("EURFER", "EURFER"): ("Âge du Fer", "Hallstatt – La Tène", -800, -25), ("EURBRO", "EURFER"): ("Âge du Bronze – Âge du Fer", "", -2300, -25), ("EURFER", "EURGAL"): ("Âge du Fer – Gallo-romain", "", -800, 500),
    ("EURBRO", "EURBRO"): ("Âge du Bronze", "", -2300, -800), ("EURGAL", "EURGAL"): ("Gallo-romain", "", -25, 500),
}
OCCUPATION_TYPES = {
    "hab_ouv": "habitat", "habitat ouvert": "habitat", "habitat": "habitat", "habitat groupé": "habitat", "nécropole": "nécropole", "necropole": "nécropole", "tumulus": "tumulus", "tombe": "nécropole",
    "sépulture": "nécropole", "oppidum": "oppidum", "fortification": "oppidum", "enceinte": "oppidum", "dépôt": "dépôt", "atelier": "atelier", "sanctuaire": "sanctuaire", "voie": "voie",
}
#: A dating dialect, in order: pattern, period, sub-period, first and last sub-period of the span.
_BOTH = ("Hallstatt/La Tène", "Ha D3 / LT A", "Ha D3 / LT A", "Ha D3 / LT A")
DATING_DIALECT = (
    (r"Ha\s*D3\s*[-/]\s*LT\s*A\d?", *_BOTH),
    (r"^Ha\s*C\s*[-/]\s*LT\s*A", *_BOTH),
    (r"^Ha\s*C\s*[-/]\s*Ha\s*D3", "Hallstatt", "Ha C", "Ha C", "Ha D3"),
    (r"Ha\s*C\s*[-/]\s*D1|hallstatt c-d[12]", "Hallstatt", "Ha C", "Ha C", "Ha D1"),
    (r"^Ha\s*D1\s*[-/]\s*D2", "Hallstatt", "Ha D1", "Ha D1", "Ha D2"),
    (r"^LT\s*B1\s*[-/]\s*C1|LT\s*B1\s*-\s*LT\s*C1", "La Tène", "LT B1", "LT B1", "LT C1"),
    (r"^LT\s*A2\s*[-/]\s*B1", "La Tène", "LT A", "LT A", "LT B1"),
    (r"^LT\s*A\s*[-/]\s*B", "La Tène", "LT A", "LT A", "LT A"),
    (r"^LT\s*B\s*[-/]\s*C|la tène b-c1", "La Tène", "LT B1", "LT B1", "LT C1"),
    (r"^LT\s*C2\s*[-/]\s*D2", "La Tène", "LT C2", "LT C2", "LT D2"),
    (r"^LT\s*C1\s*$", "La Tène", "LT C1", "LT C1", "LT C1"),
    (r"^LT\s*B\s*$", "La Tène", "LT B", "LT B1", "LT B2"),
    (r"^LT\s*A\s*$", "La Tène", "LT A", "LT A", "LT A"),
    (r"^Ha\s*D3\s*$", "Hallstatt", "Ha D3", "Ha D3", "Ha D3"),
    (r"^Ha\s*D1\s*$", "Hallstatt", "Ha D1", "Ha D1", "Ha D1"),
    (r"^Ha\s*D\s*$", "Hallstatt", "Ha D", "Ha D1", "Ha D3"),
    (r"^Ha\s*C\s*$|^Hallstatt\s*C\d?|hallstatt c1-c2", "Hallstatt", "Ha C", "Ha C", "Ha C"),
    (r"^Hallstatt\s*D1", "Hallstatt", "Ha D1", "Ha D1", "Ha D1"),
    (r"^hallstatt$", "Hallstatt", None, "Ha C", "Ha D3"),
)
UNDATED_WORDING = r"bronze final|bz fin|bz final|néolithique|epoque historique|historique|attention : cette fosse"
NOTICE_HEADER = r"^(\d{3})\s*[-–—]\s*(.+)$"
SUB_NOTICE = r"\n\s*\((\d{3}\s*[A-Z]{2}(?:,\s*\d{3}\s*[A-Z]{2})*)\)\s*[-–—]?\s*"
NOTICE_DATING = (
    r"(?i)\b(?:hallstatt|la\s+tène|âge\s+du\s+fer|âge\s+du\s+bronze|"
    r"protohistor|gallo[- ]?romain|néolith|tumulus|Ha\s*[CD]\d?|LT\s*[A-D]\d?|"
    r"premier\s+âge|second\s+âge)\b"
)
NOTICE_REMAINS = (
    r"(?i)\b(?:tumulus|tertre|sépulture|nécropole|habitat|oppidum|"
    r"fortification|enceinte|silo|fosse|four|atelier|dépôt|"
    r"tombe|inhumation|incinération|urne|céramique|tessons?|"
    r"fibule|bracelet|épée|monnaie)\b"
)
CITATION = r"([A-Z][a-zà-ÿ]+(?:\s+et\s+alii)?,\s*\d{4}[a-z]?)"
INDEX_ENTRY = r"^([A-Za-zÀ-ÿ][A-Za-zÀ-ÿ\s,\-\'()«»]+?)\s*:\s*(\d{3}.*)"
INDEX_SKIP = r"^\s*-\s*[A-Z]\s*-\s*$|^\s*Index alphabétique|^\s*68\s+Haut-Rhin\s*$|^\s*$"
INDEX_CROSS = r"(?i)cf\.?\s+(?:aussi\s+|surtout\s+)?([a-zéèêàâîôùüö\s,]+)"
SCOPE_PLACE = r"^[A-ZÀÂÄÉÈÊËÏÎÔÙÛÜÇŒÆ][\wÀ-ÿ'\-]+(?:\s*[-–]\s*[\wÀ-ÿ'\-]+)?"
SCOPE_STOPWORDS = (
    "Carte", "Gaule", "Nouvelle", "Musée", "Alsace", "France", "Europe", "Manuel", "Archéologie", "Bronzes", "Essai", "Cahiers", "Histoire", "Ancienne", "Premier", "Haut", "Bas", "Étude", "Éditions",
    "Série", "Table", "Les", "Des", "Sur", "Par", "Dans", "Pour",
)
SCOPE_TYPES = ("nécropole", "oppidum", "habitat", "tumulus", "sanctuaire", "dépôt", "atelier")
PLACE_SPLIT = r"^([A-Za-zÀ-ÿ\-]+(?:\s+[A-Za-zÀ-ÿ\-]+)?)\s+(.+)$"
ID_COLUMNS = ("SITE_AKG_ID", "id_site", "id", "EA", "Code_national_de_l_EA", "EA_NATCODE")
GEO_COLUMNS = {
    "lat": ("latitude", "y", "y(l93)", "coordonnées y (lambert 93)"), "lon": ("longitude", "x", "x(l93)", "coordonnées x (lambert 93)"), "epsg": ("projection_system", "epsg_coord", "epsg"),
}
PLATFORMS = (
    ("Patriarche", "Patriarche (base nationale EA)"), ("AFEAF", "AFEAF (Association Française pour l'Étude de l'Âge du Fer)"), ("afeaf", "AFEAF (Association Française pour l'Étude de l'Âge du Fer)"),
    ("cag_68", "Carte Archéologique de la Gaule — Haut-Rhin (68)"), ("ea_fr", "Entités Archéologiques (base nationale France)"), ("Proto_Alsace", "Base de données Protohistoire Alsace"), ("Alsace_Basel", "Base Alsace–Bâle âge du Fer"),
)
GERMAN_DATABASES = ("bade", "baden", "adab", "nordbaden", "südbaden", "wurtemberg")
LAST_ROMAN_YEAR = 500

#: Bounds in Lambert-93.
UPPER_RHINE = (930_000.0, 1_060_000.0, 6_710_000.0, 6_990_000.0)
TRUSTED = ("patriarche", "bdd_proto_alsace", "necropoles", "inhumations_silos", "afeaf")
IRON_AGE = (-800, -25)


def type_aliases() -> list[tuple[int, str, str]]:
    """(place, lower-cased alias, type): the first place of an alias with its last type."""
    place: dict[str, int] = {}
    kind: dict[str, str] = {}
    for t, aliases in TYPE_ALIASES.items():
        for a in aliases:
            place.setdefault(a.lower(), len(place))
            kind[a.lower()] = t
    return [(i, a, kind[a]) for a, i in place.items()]
#: A place name, site words and finding verbs of the running-text grammar.
PLACE_NAME = r"([A-ZÀÂÄÉÈÊËÏÎÔÙÛÜÇŒÆ][\wÀ-ÿ'\-]+(?:\s*[-–]\s*[\wÀ-ÿ'\-]+)?(?:\s+(?:de|d'|du|la|le|les|sur|sous|am|bei|im)\s+[\wÀ-ÿ'\-]+){0,2}(?:\s+[A-ZÀÂÄÉÈÊËÏÎÔÙÛÜÇŒÆ][\wÀ-ÿ'\-]+){0,2})"
SITE_WORDS = (
    r"habitat|oppidum|nécropole|necropole|tumulus|enceinte|établissement|etablissement|"
    r"sépulture|sepulture|nécropoles|necropoles|site\s+archéologique|site\s+archeologique|"
    r"tumuli|oppida|habitats|sanctuaire|atelier|dépôt|depot|fortification|fossé|fosse|"
    r"camp|castellum|villa|vicus|ferme|grange|four|fourneau|mine|carrière|rempart|murus"
)
FINDING = r"(?:fouill[eé]s?|découvert[es]?|trouvé[es]?|mis\s+au\s+jour|exhumé[es]?).{0,60}?(?:à|de|près\s+de)\s+"
BEFORE_PLACE = r"(?:\s+(?:de|du|d'|des|à|a|près\s+de|near|bei|von|in)\s+)?"
#: Wordings of the worded dialects.
BRONZE_WORDING = r"\bbz\b|bronze\s*moyen|bronze\s*final|\bbm\b"
IRON_WORDED = r"hallstatt|ha\s*[cd]|la\s*tène|latène|lt\s*[a-d]"
HALLSTATT_WORDING = r"\bha\s*[cd]\d?"
LA_TENE_WORDING = r"\blt\s*[a-d]\d?"
TRANSITION_WORDING = r"ha\s*d3\s*[-/]\s*lt\s*a|d3\s*[-–]\s*lt\s*a|hallstatt.*lt\s*a"
#: Parts of the names of columns that hold no yes or no.
NOT_ENUMS = ("genre", "sexe", "datation", "mobilier", "c14", "phase", "site", "n_st", "nmi", "individu", "dpt")
