"""Fixed values a run uses unless the caller passes others."""

SEED = 42
TEST_SHARE = 0.2
NEGATIVE_RATIO = 2
LAST_PRODUCTS = 5
TARGET_MONTHS = 6
UNKNOWN = "unknown"
NO_PICK = "z"

# Product classes and categories that are never recommended.
EXCLUDED_CLASSES = ["34.실손", "80.미니보험"]
EXCLUDED_CATEGORIES = ["34.실손", "36.단체", "기타"]

# Categories left out in addition, by a word in the data set name. The first
# word found decides.
VARIANT_CATEGORIES = {
    "small_category": ["42.변액연금", "12.변액종신", "52.변액저축", "20.CI", "35.정기", "33.상해"],
    "del_variable": ["42.변액연금", "12.변액종신", "52.변액저축"],
}

# Categories the older recommender could pick.
BASELINE_CATEGORIES = ["38.건강", "37.치아", "43.적격연금", "32.암", "20.CI", "41.일반연금",
                       "33.상해", "11.일반종신", "39.간병", "12.변액종신", "42.변액연금"]

# Fixed value: product class left out of the monthly trend.
TREND_EXCLUDED_CLASSES = ["80.미니보험"]

# Customer attributes by kind.
CUSTOMER_CATEGORICAL = ["계약자성별", "외국인여부", "BP상태코드", "컨설턴트여부", "임직원여부", "관심고객여부",
                        "VIP등급", "우량직종여부", "직업대분류", "직업군_관계사공통기준", "투자성향",
                        "업종1", "업종2"]
CUSTOMER_NUMERIC = ["계약자연령", "추정소득", "최근계약경과월"] + [f"F{number:05d}" for number in range(3, 13)]


def variant_categories(data_name: str, otherwise: list[str] | None = None) -> list[str]:
    """Extra categories to leave out for a data set name."""
    for word, categories in VARIANT_CATEGORIES.items():
        if word in data_name:
            return categories
    return otherwise or []
