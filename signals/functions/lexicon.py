r"""Fixed values of the comment rules: vocabularies, word lists and written patterns.

They decide the labels, so they are data, stated once. Words are separated by spaces.
Patterns are regular-expression fragments matched as whole words: the boundary at each end
is added by ``signals.functions.patterns`` and ``\w*`` marks a stem.
"""

# Closed vocabularies.
CLASSES = {
    "language": ["fr", "nouchi", "en", "mixed", "other"],
    "sentiment": ["positive", "negative", "neutral"],
    "theme": [
        "taste", "price", "availability", "delivery", "packaging",
        "health", "service", "promotion", "product_question", "other",
    ],
    "product": ["bissap", "gingembre", "bouye", "multiple", "none", "unknown"],
}
# Label of a field the scorer leaves out or fills with an unknown word.
DEFAULTS = {"language": "other", "sentiment": "neutral", "theme": "other", "is_spam": False}
TRUTHY = ["true", "1", "yes"]
FALSY = ["false", "0", "no"]
# Themes about the drink itself, so an unnamed product is "unknown".
PRODUCT_THEMES = [
    "taste", "price", "availability", "packaging", "health", "product_question",
]

# Slang markers.
SLANG_WORDS = "dèh deh wallah drap enjaillant enjaillé paa wê tchê cé gbê gbé kpakpato môgô".split()

# French markers, one is enough.
FRENCH_WORDS = (
    "le la les un une des du de au aux ce cet cette ces "
    "mon ma mes ton ta tes son sa ses notre nos votre vos leur leurs "
    "je tu il elle nous vous ils elles on me te se lui y en "
    "est sont es suis être avoir ai as a avons avez ont faire fait "
    "pour avec dans sur sous entre chez sans contre vers depuis pendant avant après "
    "comme mais ou et donc car que qui "
    "plus moins bien très trop assez beaucoup toujours jamais souvent encore déjà "
    "maintenant ici là comment pourquoi quand quel quelle quels quelles quoi "
    "bonjour bonsoir salut merci svp félicitations bravo "
    "français française aujourd'hui demain hier beau belle bon bonne mauvais mauvaise "
    "chose personne problème question réponse besoin beauté boisson goût produit "
    "acheter achète prix combien"
).split()

# English markers, counted once each.
ENGLISH_WORDS = (
    "the this that these those my your his her its our their some any each every all "
    "i you he she it we they him us them "
    "am is are was were be been being have has had do does did could "
    "will would shall should may might must "
    "with for from to in at by about into over under between without and because if than while "
    "what why when where who which how very more most less "
    "always never already still now today tomorrow yesterday "
    "please thanks hello hi goodbye welcome sorry congratulations "
    "great sweet tasty good delicious bad better best amazing awesome nice beautiful "
    "love like enjoy want need price cost drink juice taste flavor product buy available sugar"
).split()
# Markers that count on top of the words above ("her" is listed twice).
ENGLISH_EXTRA = [r"her", r"how\s+much", r"how\s+many", r"thank\s+you"]
# One of these alone is enough for English.
STRONG_ENGLISH = [r"thank\s+you", r"how\s+much", "please", "delicious", "tasty"]

# Spam.
SPAM_PATTERNS = [
    r"boost(?:e|es|ez)\s+vos\s+followers",
    r"follow\s*back",
    r"f4f",
    r"follow\s+for\s+follow",
    r"(?:like|follow)\s+for\s+(?:like|follow)",
    r"suis[- ]moi\b.*\bje te suis",
    r"abonne[- ]toi",
    r"pr[êe]t\s+d[' ]argent\b.*\bsans\s+garantie",
    r"sans\s+garantie\b.*\b(?:contact|whatsapp|appel|dm)",
    r"formation\b.*\b(?:trading|crypto|forex)",
    r"perte\s+de\s+poids",
    r"dm\b.*\b(?:follow|followers|abonn[ée]s)",
    r"(?:gagnez|gagner)\b.*\b(?:argent|followers|abonn[ée]s)",
    r"(?:gagnez|gagner)\s+\d\w*",
    r"cliquez\s+ici",
    r"bit\.ly",
    r"vends",
    r"0\d(?:\s?\d{2}){4}",
]

# Positive markers.
POSITIVE_PATTERNS = [
    "j'adore", "j aime", "j'aime", "j'apprécie", "j apprécie", "adore(?:nt|z)?",
    "ne regrette pas", "bravo", "félicitations",
    "bon", "bonne", "excellent", "excellente", "delicieux", "delicieuse", "délicieux",
    "délicieuse", "savoureux", "savoureuse", "super", "parfait", "parfaite", "top",
    "meilleure?s?", "nickel", "jolie?s?", "belle", "dr[ôo]le", "doux", "rapide",
    r"bien\s+(?:fait|plac[ée]e?|organis[ée]e?)",
    r"c(?:'est|é)?\s+(?:propre|frais)",
    r"enjaill\w*",
    r"(?:no|pas)\s+drap",
    "gb[êé]",
    "great", "love", "amazing",
]
# Negative markers.
NEGATIVE_PATTERNS = [
    "je n'aime pas", "je n aime pas", "je déteste", "je deteste", "arr[êe]tez",
    "mauvais", "mauvaise", "cher", "chere", "chère", "cheres", "chères",
    "degoutant", "dégoutant", "degoutante", "dégoutante", "lente?", "difficile",
    r"r[ée]p[ée]titi\w*",
    r"c(?:'est|é)\s+chaud",
    "baisser", "diminuez",
    r"encore\s+mont[ée]",
    "fuit", "fuite", "cassé", "cassee", "cassée", "probleme", "problème", "plainte",
    "annul[ée]e?",
    r"ne\s+r[ée]pond\s+pas",
    r"toujours\s+rien",
    r"d[ée]coll\w*",
    "introuvable", "rupture",
    r"stock\s+fini",
    r"plus\s+rien",
    r"ne\s+trouve\s+plus",
    r"pas\s+au\s+ma(?:qu|k)is",
    r"plus\s+de\s+(?:bissap|gingembre|bouye)",
    r"bouti(?:que|ke)s?,?\s+rien",
]
# A negation up to three words before a marker flips it.
NEGATIONS = ["pas", "plus", "jamais", "aucunement", "pas du tout"]
# Hedged wording the rules do not judge.
HEDGES = [
    "je ne dirais pas", "je ne pense pas", "je ne crois pas", "on ne peut pas dire",
    "pas vraiment", "pas tellement", "pas particulierement", "pas particulièrement",
]

# Product names.
PRODUCT_PATTERNS = {
    "bissap": ["bissap", "hibiscus"],
    "gingembre": ["gingembre"],
    "bouye": ["bouye"],
}
# Themes.
THEME_PATTERNS = {
    "delivery": [r"livr\w*", r"command\w*", "ship", "delivery"],
    "availability": [
        "stock", "rupture", r"plus\s+rien", r"en\s+rayon", r"disponib\w*", "available",
        "introuvable", "trouve", r"supermarch\w*", "bouti(?:que|ke)s?",
        r"pas\s+au\s+ma(?:qu|k)is", r"plus\s+de\s+(?:bissap|gingembre|bouye)",
        r"c(?:'est|é)?\s+fini", r"where\s+can\s+i\s+buy", "avez[- ]vous",
        r"vous avez\b.*\b(?:bissap|gingembre|bouye)",
    ],
    "price": [
        "prix", "ch[èe]re?s?", "co[uû]te?", "combien", "francs?", "fcfa", r"à\s+\d{3,}", "price",
    ],
    "packaging": [
        "bouteille", "emballage", "packaging", "[ée]tiquette", "format", "fuit", "fuite",
        "bouchon", "packs?", r"\d+\s?(?:cl|l)",
    ],
    "health": [
        "sucre", "conservateurs?", "sant[ée]", "ingr[ée]dients?", "calories?", r"diab[ée]t\w*",
    ],
    "promotion": [
        "pubs?", r"publicit\w*", "radio", "tiktok", r"influenc\w*", "stand", "promo(?:tion)?s?",
        "campagne", "vid[ée]o", "d[ée]gustation", r"vu\s+chez\s+@",
    ],
    "taste": [
        r"go[uû]t\w*", "sucr[ée]e?", "fra[iî]s", "fra[iî]che", r"d[ée]licieu\w*",
        r"savoureu\w*", "bon", "bonne", "doux", "adore(?:nt|z)?", "meilleure?", "qualit[ée]",
        "kalit[ée]", "tasty", "delicious",
    ],
    "product_question": [
        "quel produit", "quel est ce produit", "c'est quoi", "composition", "version",
        "sugar[- ]free", "naturel", "concentr[ée]",
    ],
    "service": ["payer", "paiement", r"service\s+client"],
}
# When both are found, the key wins over the listed themes.
THEME_PRIORITY = {
    "product_question": ["health", "taste"],
    "health": ["taste"],
    "promotion": ["taste"],
    "price": ["taste", "packaging"],
    "delivery": ["service", "availability"],
}
# Slang praise counts as taste only when a product is named.
TASTE_IF_PRODUCT = [r"enjaill\w*"]

# Openings and stock endings that carry no opinion.
LEADING_FILLERS = ["bon", "mais", "eh", "hey"]
TRAILING_FILLER = r"(?:qui|ki) est comme moi"
# Comments that only keep a conversation going.
CONVERSATIONAL = [
    "bonjour", "bonsoir", "salut", "slt", "bjr", "merci(?: pour l'info)?", "je confirme",
    "exact", r"\+1", "pareil(?: chez moi)?", "mdr", "ok", "d'accord",
]

# Emoji that carry a sentiment when nothing is written.
POSITIVE_EMOJI = ["❤", "😍", "😋", "👍", "👌", "💪", "🔥", "👏", "🥰", "😊", "🙏"]
NEGATIVE_EMOJI = ["😡", "😤", "👎", "😒", "😭", "🤮", "😠"]

# Other names under which scorers give a theme.
THEME_ALIASES = {
    "quality": "taste",
    "sweetness": "taste",
    "degustation": "taste",
    "food": "taste",
    "bouteille": "packaging",
    "couleur": "packaging",
    "radio": "promotion",
    "tiktok": "promotion",
    "boosting followers": "promotion",
    "boosting": "promotion",
    "stand organized": "promotion",
    "question sur un produit": "product_question",
    "achat": "product_question",
    "stock fini": "availability",
    "fini": "availability",
    "location": "availability",
    "annulation": "service",
    "disconnection": "service",
    "frustration": "service",
    "bouye": "other",
    "jeux de mots": "other",
    "friendship": "other",
    "conservateur": "health",
}
