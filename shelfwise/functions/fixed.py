"""Word lists, unit tables and patterns of the matching rules."""

# ---- Fixed values: results depend on exactly these, so they are stated as they are. ----

#: Words that are spelled out before matching; first those applied before "&" becomes "and", then those after.
SPELLED_FIRST = {
    "PKT": "PACKET", "PKTS": "PACKET", "BX": "BOX", "BTL": "BOTTLE", "SACH": "SACHET", "SACHE": "SACHET",
    "PC": "PIECE", "PCS": "PIECE", "FZ": "FROZEN", "FRZN": "FROZEN", "FRSH": "FRESH", "DRD": "DRIED",
    "RSTD": "ROASTED", "SMKD": "SMOKED", "GRLLD": "GRILLED", "MRND": "MARINATED", "INST": "INSTANT",
    "ACTV": "ACTIVE", "ORG": "ORGANIC", "ORGNC": "ORGANIC", "NAT": "NATURAL", "NTRL": "NATURAL",
    "UNSWT": "UNSWEETENED", "UNSWTND": "UNSWEETENED", "SWT": "SWEET", "UNSTD": "UNSALTED", "UNSLTD": "UNSALTED",
    "SLTD": "SALTED", "PWD": "POWDER", "PWDR": "POWDER", "PWR": "POWDER", "BKG": "BAKING", "BAK": "BAKING",
    "BICRBNTE": "BICARBONATE", "BICARB": "BICARBONATE", "CKN": "CHICKEN", "CHKN": "CHICKEN", "CHCKN": "CHICKEN",
    "CHS": "CHEESE", "CHEZ": "CHEESE", "CHDR": "CHEDDAR", "MZRLA": "MOZZARELLA", "MZRELLA": "MOZZARELLA",
    "VEG": "VEGETABLE", "VGE": "VEGETABLE", "GHE": "GHEE", "BTR": "BUTTER", "BTTR": "BUTTER",
    "CHOC": "CHOCOLATE", "CHOCO": "CHOCOLATE",
    "STRWB": "STRAWBERRY", "STRWBRY": "STRAWBERRY", "STRWBERY": "STRAWBERRY", "STRWBERRY": "STRAWBERRY",
    "RSPB": "RASPBERRY", "RSPBRY": "RASPBERRY", "RSPBERY": "RASPBERRY", "RSPBERRY": "RASPBERRY",
    "BLBR": "BLUEBERRY", "BLBRRY": "BLUEBERRY", "BLBRERY": "BLUEBERRY", "BLBRERRY": "BLUEBERRY",
    "EVDAY": "EVERYDAY", "HNY": "HONEY", "BISC": "BISCUIT", "GLUC": "GLUCOSE", "PNAPL": "PINEAPPLE",
    "PNPL": "PINEAPPLE", "MNGO": "MANGO", "APL": "APPLE", "BRZ": "BRAZIL", "BRZL": "BRAZIL",
}
SPELLED_AFTER = {
    "BISCUITS": "BISCUIT", "GLD": "GOLD", "GLDN": "GOLDEN", "LNG": "LONG", "SML": "SMALL", "MED": "MEDIUM",
    "LRG": "LARGE", "XL": "EXTRALARGE", "ORIG": "ORIGINAL", "ORGNL": "ORIGINAL", "TRD": "TRADITIONAL",
    "STD": "STANDARD", "PRM": "PREMIUM", "PRMM": "PREMIUM", "SPC": "SPECIAL", "SPCL": "SPECIAL",
    "CRSPY": "CRISPY", "CLSSC": "CLASSIC", "CLS": "CLASSIC", "FRS": "FRIES", "FFRS": "FRENCH FRIES",
    "PTT": "POTATO", "PTTO": "POTATO", "WDGS": "WEDGES", "HTDG": "HOTDOG", "NGT": "NUGGET", "NGTS": "NUGGETS",
    "STC": "STICKS", "STCKS": "STICKS", "JC": "JUICE", "CNC": "CONCENTRATE", "CRBD": "CARBONATED", "MNRL": "MINERAL",
}

BRAND_ALIASES = {
    "AME": "AMERICANA", "AMC": "AMERICANA", "AMER": "AMERICANA", "AMRCNA": "AMERICANA", "TIFF": "TIFFANY",
    "TIFFFANY": "TIFFANY", "DEEM": "DEEMAH", "AMT": "AHMADTEA", "AHMAD": "AHMADTEA", "AHMADTEA": "AHMADTEA",
    "FOSTER": "FOSTERCLARK", "FOSTERCLARK": "FOSTERCLARK", "FOSTERCLARKS": "FOSTERCLARK", "GG": "GREENGIANT",
    "GREENGIANT": "GREENGIANT", "HAPPYCOW": "HAPPYCOW", "NV": "NATUREVALLEY", "NATUREVALLEY": "NATUREVALLEY",
    "CRF": "CARREFOUR", "MCRF": "CARREFOUR", "PRES": "PRESIDENT", "HERSHEYS": "HERSHEY", "HERSHY": "HERSHEY",
    "BC": "BETTYCROCKER", "BETTY": "BETTYCROCKER", "BETTYCROCKER": "BETTYCROCKER", "LD": "LULUDAILY",
    "LULUDAILY": "LULUDAILY", "ENG": "ENGLISH", "AHMD": "AHMAD", "AHMED": "AHMAD", "MC CAIN": "MCCAIN",
    "MC": "MCCAIN", "MCCAINS": "MCCAINS", "CG": "CALIFORNIA GARDEN",
}

NOT_BRANDS = [
    "FRESH", "FROZEN", "PREMIUM", "NATURAL", "ORGANIC", "PURE", "WHOLE", "GRILLED", "ROASTED", "SMOKED",
    "BAKED", "CHILLED", "DRIED", "CANNED", "HOT", "COLD", "MINI", "MAXI", "SUPER", "EXTRA", "LIGHT", "GREEN",
    "RED", "WHITE", "BLUE", "BLACK", "YELLOW", "BROWN", "BIG", "SMALL", "MED", "NEW", "OLD", "CV", "EA", "KG",
    "GR", "GM", "ML", "CH", "BRZ", "BRAZIL", "AMERICAN", "SF", "BK", "F", "FV", "BREADED", "JUMBO", "SLICED",
    "SLICE", "STUFFED", "STRIPS", "NUGGETS", "CHICKEN", "BEEF", "FISH", "CHEESE", "TEA", "COFFEE", "JUICE",
    "WATER", "OIL", "RICE", "PASTA", "LOCAL", "BRAND", "NONE", "NAN", "CHOCOLATE", "CHOCO", "VANILLA",
    "STRAWBERRY", "RASPBERRY", "BLUEBERRY", "ORANGE", "LEMON", "MANGO", "PINEAPPLE", "BANANA", "APPLE", "PEACH",
    "CHERRY", "MINT", "CARAMEL", "COCOA", "HONEY", "PLAIN", "SPICY", "SWEET", "SOUR", "SALT", "PEPPER", "FLOUR",
    "SUGAR", "MILK", "CREAM", "YOGURT", "BUTTER", "GHEE", "BREAD", "CAKE", "COOKIES", "BISCUIT", "BISCUITS",
    "WAFER", "CRISPY", "CRUNCHY", "DELUXE", "CLASSIC", "STANDARD", "REGULAR", "FULL", "HALF", "QUARTER", "WS",
    "AL", "EL", "BIN", "IBN", "ABU", "UM", "AA",
]

STOP_WORDS = [
    "AND", "OR", "THE", "OF", "IN", "FOR", "WITH", "A", "AN", "FRESH", "FROZEN", "CHILLED", "CANNED", "DRIED",
    "WHOLE", "HALF", "SLICED", "MIXED", "ASSORTED", "PRODUCT", "PRODUCTS", "ITEM", "OTHER", "MISC",
]

#: Brands that are one, found by hand; a later group wins.
CURATED_BRANDS = [
    ["DEEMAH", "DEEMAHH"], ["DI MARTINO", "G.DI MARTINO"], ["DIVELA", "DIVELLA"], ["MAJDI", "AJDI"], ["ASAK", "ASMAK"],
    ["DSCHAR", "SCHAR"], ["HAAGE", "HAAGEN", "HAAGENDAZS"], ["KASIH", "KASSIH"], ["LOACKER", "LOCKER"], ["LOTTE", "LOTTEE"],
    ["LOV", "LOVE"], ["MC VIITIES", "MCVITIES'S"], ["MUCHEE", "MUNCHEE"], ["NAMET", "NAMLET"], ["OREAO", "OREO"], ["POMI", "POMMI"],
    ["RAYAN", "RAYYAN"], ["SEARA", "SEARRA"], ["SHAHAD", "SHAHD"], ["SICAM", "SICA"], ["SPRING", "SPRNG"], ["TACHIBO", "TCHIBO"],
    ["TAYBAT", "TAYEBAT"], ["SAHHA", "SAHA"], ["ALICAFE", "ALICAFÉ"], ["BRITANNIA", "BRITANIA"], ["TIM"],
    ["ULKER", "PLADIS : ULKER", "PLADIS : ULKER - BISKREM", "PLADIS : ULKER - HALLEY", "PLADIS :ULKER - KAT KAT TAT", "PLADIS : ULKER KELLOGGS", "PLADIS : ULKER - RONDO", "ULKER KELLOGGS"],
    ["AMERICANA GARDEN", "AMERICAN GARDEN"], ["3SUNICH", "SUNICH"], ["ABOSHEBA", "BOSHEBA"], ["ACORASA", "ACORSA", "ACORS"],
    ["ACQUA PANNA", "AQUA PANNA"], ["AL AILA", "AL AILAH"], ["AL TAGHZIAH", "TAGHZIAH"], ["BANJABI KHORY", "PANJABI KHORY"],
    ["BINGRE", "BINGREE"], ["BR BEEF", "BRZ BEEF"], ["C LUXURY", "LUXURY"], ["FRITO", "FRITOS"], ["G/SABA", "SABA"],
    ["GARDEIN", "GARDEN"], ["GDY-PASTA", "GOODY-PASTA"], ["GRAN", "GRANO"], ["HALAAL", "HALAL"], ["HILLI", "HILLLI"], ["HIPO", "HIPPO"],
    ["AHMAD", "AHMAD TEA"], ["AHMED", "AHMED FOOD"],
    ["PARLE", "PARLE - FAB!", "PARLE - HIDE & SEEK", "PARLE - KRACKJACK", "PARLE - MONACO", "PARLE - PARLE", "PARLE - PARLE-G", "PARLE - POPPINS", "PARLE - RUSK", "PARLE-G"],
    ["AL BARAKAH", "AL BARAKA", "ALBARAKA"], ["AL KABER", "AL KABEER", "ALKABEER"], ["AL MARRAI", "AL MARAI", "ALMARAI"],
    ["AL MARRAI", "AL MARAAI", "ALMARAAI"], ["AL NUTRICAA", "AL NUTRICA", "ALNUTRICA"], ["ALKRAMAH", "AL KARAMAH", "ALKARAMAH"],
    ["ALWLIMAH", "AL WALIMAH", "ALWALIMAH"], ["AL TAYAB", "AL TAYYAB", "ALTAYYAB"],
]

#: Names that stand for all of their spellings, whatever else was found.
FORCED_BRANDS = {
    "BUSH'S": ["BUSH", "BUSHS", "BUSH'S", "BUSH'S BEST"],
    "KANNAN DEVAN": ["KANNAN DEVAN", "KANNAN"],
    "KELLOGG'S": [
        "KELLOGG'S", "KELLOGGS", "KELLOGS", "KELLOGGS'S", "KELLOG'S", "KELLOGG S", "KELLOGG S IMP", "KELLOGG'S - CORN FLAKES", "KELLOGG'S - EGGO",
        "KELLOGG'S - RICE KRISPIES", "KELLOGG'S - FROSTIES", "KELLOGG'S - SPECIAL K", "KELLOGG'S - KELLOGG'S", "KELLOGG'S - COCO POPS",
        "KELLOGG'S - POP TARTS", "KELLOGG'S FROOT LOOPS", "KELLOGG'S RICE KRSPIES", "KELLOGG'S CORN POP", "KELLOGG'S GRANOLA",
    ],
    "KHALAS": ["KHALAS", "KHALAS AL NADEEM"],
}

#: Close keys that are two brands.
NOT_ONE_BRAND = [
    ("CAPRI", "CAPRIO"), ("BARAKAT", "BARAKA"), ("BUSAN", "BUSTAN"), ("BENATURAL", "NATURAL"), ("ALWANI", "HALWANI"), ("CLASSIC", "CLASSICO"),
    ("GOODWAY", "GOODDAY"), ("WALTERS", "WALKERS"), ("EUROBAKE", "EUROCAKE"), ("SUMMERFRESH", "SUPERFRESH"),
]

#: Words that may stand before the brand that a description opens with.
LEADING_SKIP_TOKENS = [
    "FZ", "CH", "FR", "SF", "BF", "KW", "JOR", "UAE", "USA", "AUS", "BRZ", "IND", "UK", "NZ", "KSA", "IQF", "RTE", "RTC", "WHL",
    "BL", "SL", "BNLS", "SKLS", "IH", "CKN", "CHK", "BF", "LMB", "MTN", "VL", "POL", "ARG", "PLND", "TUR", "CHINA", "RUS", "OMN",
    "QAR", "THAI", "KOREAN", "GEO", "S.", "S", "CO", "CO.", "FZN",
]

#: Abbreviations of brands in retail texts.
RETAIL_BRANDS = {
    "ame": "americana", "amc": "americana", "amcana": "americana", "amcn": "americana", "ame.": "americana", "amer": "americana",
    "cg": "california garden", "cal garden": "california garden", "cal": "california garden", "gg": "green giant", "g5": "green giant",
    "bc": "betty crocker", "ld": "london dairy", "londondairy": "london dairy", "l/d": "london dairy", "oep": "old el paso",
    "kdc": "kdd", "kd": "kdd", "banetti": "panzani", "sparoni": "panzani", "panz": "panzani", "siella": "sirella",
    "zawan": "zwan", "zwdh": "zwan", "bb": "butterball", "hershey's": "hershey", "cadburys": "cadbury", "indian gate": "india gate",
    "prsdnt": "president", "nurjuhan": "nurjahan", "frmland": "farmland",
}

#: Words of one group that differ between two names mark two different products.
VARIANT_GROUPS = [
    ["WHITE", "BROWN"],
    ["FULL", "SKIMMED", "SEMI"],
    ["SALTED", "UNSALTED"],
    ["SWEETENED", "UNSWEETENED"],
    ["REGULAR", "DIET", "ZERO"],
    ["LARGE", "MEDIUM", "SMALL"],
]

#: Unit: grams, millilitres or pieces in one, and its kind.
UNITS = {
    "KG": (1000.0, "mass"), "KGS": (1000.0, "mass"), "G": (1.0, "mass"), "GR": (1.0, "mass"), "GM": (1.0, "mass"),
    "GMS": (1.0, "mass"), "GRM": (1.0, "mass"), "GRMS": (1.0, "mass"), "GRAM": (1.0, "mass"), "GRAMS": (1.0, "mass"),
    "MG": (0.001, "mass"), "L": (1000.0, "vol"), "LT": (1000.0, "vol"), "LTR": (1000.0, "vol"), "LTRS": (1000.0, "vol"),
    "LITRE": (1000.0, "vol"), "LITER": (1000.0, "vol"), "ML": (1.0, "vol"), "CL": (10.0, "vol"), "CC": (1.0, "vol"),
    "S": (1.0, "count"),
}

SIZE = r"(\d+(?:\.\d+)?)\s*(KG|KGS|G|GR|GM|GMS|GRM|GRMS|GRAMS?|MG|L|LT|LTR|LTRS|LITRE|LITER|ML|CL|CC|S)\b"
PACK = r"\b(\d+\s*X\s*\d+(?:\s*X\s*\d+(?:\.\d+)?)?(?:\s*(?:KG|KGS|G|GR|GM|GMS|ML|L|LT|LTR|LTRS|MG|S))?)\b"
GLUED = r"(\d+(?:\.\d+)?)\s*(KG|KGS|G|GR|GM|GMS|ML|L|LT|LTR|MG|S)\s*X\s*(\d+)\b"
#: What else is cut out of a name, after glued sizes, packs and sizes.
NAME_CUTS = [r"\bX\s*\d+\b", r"\bWS\b"]
PRODUCT_CODE = r"\(\s*\d{5,}\s*\)"

#: Header patterns: first those of code columns, then of category columns, then of description columns.
CODE_HEADERS = [
    r"\bsku\b", r"\bbarcode\b", r"\bbar[\s_-]?code\b", r"\bupc\b", r"\bean\b", r"\bgtin\b",
    r"\bitem[\s_-]?(code|no|number|id|#)\b", r"\bproduct[\s_-]?(code|no|number|id|#)\b",
    r"\bmaterial[\s_-]?(code|no|number|id|#)\b", r"\bmaterial\b", r"\bpart[\s_-]?(code|no|number|id|#)\b",
    r"\barticle[\s_-]?(code|no|number|id|#)\b", r"\bcatalog[\s_-]?(code|no|number|id|#)\b",
    r"\bref(?:erence)?[\s_-]?(code|no|number|id|#)?\b", r"\bhsn\b", r"\bmodel[\s_-]?(code|no|number|id|#)\b",
]
CATEGORY_HEADERS = [
    r"\bcategor", r"\bfamily\b", r"\bgroup\b", r"\bdepartment\b", r"\bdept\b", r"\bdivision\b", r"\bsection\b",
    r"\bmgrp_descr\b", r"\bprdh_descr_1\b", r"\bprdh_descr_3\b", r"\bsegment\b", r"\bhierarch", r"\bprdh",
    r"\bl[1-3]\b", r"\blevel\b", r"\bclass\b", r"\brange\b", r"\btype\b",
]
DESCRIPTION_HEADERS = [
    r"\bdescri", r"\bproduct[\s_-]?name\b", r"\bitem[\s_-]?name\b", r"\bmaterial[\s_-]?desc", r"\bmat[\s_-]?desc",
    r"^name$", r"\btitle\b", r"\bgoods\b", r"\bcommodity\b", r"\blabel\b", r"\bvariant\b", r"\barticle[\s_-]?desc",
    r"\bretail[\s_-]?article",
]
BRAND_HEADERS = [r"^brand$", r"\bbrand[\s_-]?(name|desc|text)\b", r"\bmanufactur", r"\bsupplier\b", r"\bvendor\b"]

#: Retail texts: units to one spelling, then words to one spelling; each list in order.
RETAIL_UNITS = [
    (r"\b(ltr|lt|litre|liter|liters|litres)\b", "l"), (r"\b(grm|gms|gram|grams|gr|gm)\b", "g"),
    (r"\b(mltr|milliliter|millilitre)\b", "ml"), (r"\b(kilogram|kilograms)\b", "kg"), (r"\b(ounce|ounces)\b", "oz"),
    (r"\b(piece|pieces)\b", "pcs"), (r"\b(packet|packets|pkt)\b", "pack"),
]
RETAIL_WORDS = [
    (r"\bamcana\b", "americana"), (r"\b(ame|amc|amcn)\b", "americana"), (r"\bcal garden\b", "california garden"),
    (r"\b(cg)\b", "california garden"), (r"\b(oep)\b", "old el paso"), (r"\b(gg)\b", "green giant"),
    (r"\b(bc)\b", "betty crocker"), (r"\b(ld)\b", "london dairy"), (r"\blondondairy\b", "london dairy"),
    (r"\b(kdc|kd)\b", "kdd"), (r"\b(ckn|chk|chkn)\b", "chicken"), (r"\b(fz|frz)\b", "frozen"),
    (r"\b(veg|veget)\b", "vegetable"), (r"\b(choc|choco)\b", "chocolate"),
    (r"\b(str|strw|straw|strbry|strwbry)\b", "strawberry"), (r"\b(van|vnla|vanla)\b", "vanilla"),
    (r"\b(msh|mshm)\b", "mushroom"), (r"\bzawan\b", "zwan"), (r"\bsiella\b", "sirella"),
    (r"\bindian gate\b", "india gate"), (r"\bnurjuhan\b", "nurjahan"), (r"\btawouk\b", "taouk"),
    (r"\b(ornge?|orng)\b", "orange"), (r"\b(moz|mozarella|mozzrla)\b", "mozzarella"), (r"\b(jce|juc|nectar)\b", "juice"),
    (r"\bbanetti\b", "panzani"), (r"\bsparoni\b", "panzani"), (r"\b(rusk|bisc)\b", "biscuit"), (r"\bnacho\b", "tortilla"),
    (r"\b(gr|gm)\b", "g"), (r"\bmedamma[s]?\b", "foul"), (r"\bcalrose\b", "jasmine"), (r"\b(sella|rozana)\b", "basmati"),
    (r"\bprsdnt\b", "president"), (r"\bcadburys\b", "cadbury"), (r"\bsaralee\b", "sara lee"), (r"\b(ec|qnie|new)\b", ""),
]
RETAIL_STOP_WORDS = [
    "the", "a", "an", "and", "or", "of", "in", "for", "with", "by", "from", "to", "at", "on", "is", "are",
    "new", "original", "premium", "special", "classic", "natural", "fresh", "pure", "extra", "super", "ultra",
    "mini", "big", "large", "small", "best", "real", "true", "fine", "frozen", "chilled", "hot", "spicy",
    "crispy", "crunchy", "regular", "light", "full", "fat", "low", "rich", "deluxe", "assorted", "asstd",
    "asst", "prm", "prem", "std", "alu", "tetra", "cpd", "chopped", "whole", "sliced", "shredded", "diced",
    "minced", "bottle", "jar", "tub", "pouch", "family", "traditional", "artisan", "sugar", "lean", "skimmed",
    "piece", "stem", "chunk", "strip", "sachet", "squeeze", "spray", "drinking", "mineral", "spring",
    "purified", "organic", "bio", "homestyle", "kids", "junior", "baby", "adult", "promo", "offer", "deal",
    "halal", "kosher", "vegan", "vegetarian", "gold", "silver", "platinum", "bronze", "smoked", "roasted",
    "grilled", "baked", "boiled", "cooked", "marinated", "seasoned", "unseasoned", "breaded",
]
NAME_STOP_WORDS = [
    "of", "the", "a", "an", "and", "or", "with", "for", "in", "on", "at", "to", "by", "new", "fresh",
]

#: Numbers as text: brackets and a trailing minus mean a negative number, commas and spaces go; identifiers lose a decimal zero.
NUMBER_IN_BRACKETS, NUMBER_MARKS, TRAILING_MINUS = r"^\((.*)\)$", r"[,\s]", r"^([+-]?[0-9]*\.?[0-9]+)-$"
DECIMAL_ZEROS = r"\.0+$"

TIMESTAMP_FORMATS = [
    "M/d/yy H:mm", "M/d/yyyy H:mm", "M/d/yy HH:mm", "M/d/yyyy HH:mm", "M/d/yy H:mm:ss", "M/d/yyyy H:mm:ss",
    "yyyy-MM-dd HH:mm:ss", "yyyy-MM-dd H:mm:ss", "yyyy-MM-dd HH:mm", "yyyy-MM-dd H:mm",
]
DATE_FORMATS = ["M/d/yy", "M/d/yyyy", "yyyy-MM-dd", "yyyy/MM/dd", "yyyy.MM.dd"]
#: Columns that hold identifiers.
IDENTIFIERS = ["po", "line", "vendor", "plant", "material"]

# ---- End of fixed values. ----
