"""Fixed values the rules depend on. They are contracts, so they are spelled out here once."""

from __future__ import annotations

# Split names, in the order that decides allocation ties.
SPLITS = ("train", "val", "test")

# Class treated as "not part of the taxonomy" by the binary gate.
OTHER = "other"

# Accepted file extensions per step.
CLEAN_EXTENSIONS = ("jpg", "jpeg", "png", "bmp", "gif", "webp")
CROP_EXTENSIONS = ("jpg", "jpeg", "png")
LOADER_EXTENSIONS = ("jpg", "jpeg", "png", "bmp", "gif")
UPLOAD_EXTENSIONS = ("jpg", "jpeg", "png", "bmp", "webp", "gif")

# Class key -> (english name, vietnamese name).
CLASS_METADATA = {
    "ambarella": ("ambarella", "coc"),
    "apple": ("apple", "tao"),
    "avocado": ("avocado", "bo"),
    "banana": ("banana", "chuoi"),
    "bell_pepper": ("bell_pepper", "ot_chuong"),
    "bitter_gourd": ("bitter_gourd", "kho_qua"),
    "black_mullberry": ("black_mulberry", "dau_tam_den"),
    "burmese_grape": ("burmese_grape", "dau_da"),
    "caimito": ("caimito", "vu_sua"),
    "canistel": ("canistel", "le_kima"),
    "cantaloupe": ("cantaloupe", "dua_luoi"),
    "cape_gooseberry": ("cape_gooseberry", "tam_bop"),
    "carambola": ("carambola", "khe"),
    "cashew": ("cashew", "dieu"),
    "cempedak": ("cempedak", "mit_to_nu"),
    "coconut": ("coconut", "dua"),
    "coffee": ("coffee", "ca_phe"),
    "dragonfruit": ("dragonfruit", "thanh_long"),
    "durian": ("durian", "sau_rieng"),
    "eggplant": ("eggplant", "ca_tim"),
    "grape": ("grape", "nho"),
    "guanabana": ("guanabana", "mang_cau_xiem"),
    "guava": ("guava", "oi"),
    "jackfruit": ("jackfruit", "mit"),
    "lime": ("lime", "chanh"),
    "longan": ("longan", "nhan"),
    "mango": ("mango", "xoai"),
    "mangosteen": ("mangosteen", "mang_cut"),
    "otaheite_apple": ("otaheite_apple", "man_roi"),
    "other": ("other", "khac"),
    "papaya": ("papaya", "du_du"),
    "passion_fruit": ("passion_fruit", "chanh_day"),
    "peanut": ("peanut", "dau_phong"),
    "pineapple": ("pineapple", "dua"),
    "pomegranate": ("pomegranate", "luu"),
    "pomelo": ("pomelo", "buoi"),
    "red_mulberry": ("red_mulberry", "dau_tam_do"),
    "ridged_gourd": ("ridged_gourd", "muop_khia"),
    "sapodilla": ("sapodilla", "sa_po_che"),
    "strawberry": ("strawberry", "dau_tay"),
    "sugar_apple": ("sugar_apple", "na"),
    "tomato": ("tomato", "ca_chua"),
    "watermelon": ("watermelon", "dua_hau"),
    "zucchini": ("zucchini", "bi_ngoi"),
}

# Merged class -> classes folded into it.
MERGE_GROUPS = {
    "mulberry": ("black_mulberry", "red_mulberry", "mulberry", "mullberry"),
    "jackfruit_cempedak": ("cempedak", "jackfruit", "jackfruit_cempedak"),
    "gourd": ("bitter_gourd", "ridged_gourd", "gourd"),
}

# Upload folder spellings mapped to a class.
UPLOAD_ALIASES = {
    "jackfruit": "jackfruit_cempedak",
    "cempedak": "jackfruit_cempedak",
    "suger_apple": "sugar_apple",
    "sugarapple": "sugar_apple",
}

# Real classes that the first production model does not know.
UNSUPPORTED_V1 = (
    "bell_pepper",
    "coffee",
    "lime",
    "longan",
    "mango",
    "gourd",
    "canistel",
    "burmese_grape",
)

# Upload folders that hold no class at all.
OUT_OF_SCOPE = ("other", "hard", "unknown", "manual_review")

# Derived lookups.
MERGE_RULES = {source: target for target, group in MERGE_GROUPS.items() for source in group}
PRE_MERGE_NAMES = tuple(sorted(s for s, t in MERGE_RULES.items() if s != t))
KNOWN_CLASSES = tuple(
    sorted(
        set(MERGE_RULES)
        | set(MERGE_RULES.values())
        | set(CLASS_METADATA)
        | {english for english, _ in CLASS_METADATA.values()}
    )
)
LABEL_ALIASES = {
    **{key: english for key, (english, _) in CLASS_METADATA.items()},
    **{english: english for english, _ in CLASS_METADATA.values()},
    **{target: target for target in MERGE_GROUPS},
}
