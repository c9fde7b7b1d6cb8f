"""Dataset schemas as DDL.

The column names, their order and their types are fixed values: readers of the
datasets depend on them.
"""

from __future__ import annotations

from functools import lru_cache

from pyspark.sql import types as T

# --- fixed values: nested types -------------------------------------------------
NESTED = {
    "@language_list": "ARRAY<STRUCT<lang STRING, text STRING>>",
    "@size": "STRUCT<h INT, w INT>",
    "@images": (
        "ARRAY<STRUCT<key STRING, imgid INT, rev INT, "
        "sizes STRUCT<`100` @size, `200` @size, `400` @size, full @size>, "
        "uploaded_t BIGINT, uploader STRING>>"
    ),
    "@nutriments": (
        "ARRAY<STRUCT<name STRING, value FLOAT, `100g` FLOAT, serving FLOAT, unit STRING, "
        "prepared_value FLOAT, prepared_100g FLOAT, prepared_serving FLOAT, prepared_unit STRING>>"
    ),
    "@packagings": (
        "ARRAY<STRUCT<material STRING, number_of_units BIGINT, quantity_per_unit STRING, "
        "quantity_per_unit_unit STRING, quantity_per_unit_value STRING, recycling STRING, "
        "shape STRING, weight_measured FLOAT>>"
    ),
    "@owner_fields": "ARRAY<STRUCT<field_name STRING, timestamp BIGINT>>",
    "@categories_properties": (
        "STRUCT<ciqual_food_code INT, agribalyse_food_code INT, agribalyse_proxy_food_code INT>"
    ),
}

# --- fixed values: food columns -------------------------------------------------
# "tags" stands for a list of texts.
FOOD_COLUMNS = """
additives_n INT, additives_tags tags, allergens_tags tags, brands_tags tags, brands STRING,
categories STRING, categories_tags tags, categories_properties @categories_properties,
checkers_tags tags, ciqual_food_name_tags tags, cities_tags tags, code STRING,
compared_to_category STRING, complete INT, completeness FLOAT, correctors_tags tags,
countries_tags tags, created_t BIGINT, creator STRING, data_quality_errors_tags tags,
data_quality_info_tags tags, data_quality_warnings_tags tags, data_sources_tags tags,
environmental_score_data STRING, environmental_score_grade STRING, environmental_score_score INT,
environmental_score_tags tags, editors tags, emb_codes_tags tags, emb_codes STRING,
entry_dates_tags tags, food_groups_tags tags, generic_name @language_list, images @images,
informers_tags tags, ingredients_analysis_tags tags, ingredients_from_palm_oil_n INT,
ingredients_n INT, ingredients_original_tags tags, ingredients_percent_analysis INT,
ingredients_tags tags, ingredients_text @language_list, ingredients_with_specified_percent_n INT,
ingredients_with_unspecified_percent_n INT, ingredients_without_ciqual_codes_n INT,
ingredients_without_ciqual_codes tags, ingredients STRING, known_ingredients_n INT,
labels_tags tags, labels STRING, lang STRING, languages_tags tags, last_edit_dates_tags tags,
last_editor STRING, last_image_t BIGINT, last_modified_by STRING, last_modified_t BIGINT,
last_updated_t BIGINT, link STRING, main_countries_tags tags, manufacturing_places_tags tags,
manufacturing_places STRING, max_imgid INT, minerals_tags tags, misc_tags tags,
new_additives_n INT, no_nutrition_data BOOLEAN, nova_group INT, nova_groups_tags tags,
nova_groups STRING, nucleotides_tags tags, nutrient_levels_tags tags, nutriments @nutriments,
nutriscore_grade STRING, nutriscore_score INT, nutrition_data_per STRING, obsolete BOOLEAN,
origins_tags tags, origins STRING, owner_fields @owner_fields, owner STRING,
packagings_complete BOOLEAN, packaging_recycling_tags tags, packaging_shapes_tags tags,
packaging_tags tags, packaging_text @language_list, packaging STRING, packagings @packagings,
photographers tags, popularity_key BIGINT, popularity_tags tags, product_name @language_list,
product_quantity_unit STRING, product_quantity STRING, purchase_places_tags tags,
quantity STRING, rev INT, scans_n INT, serving_quantity STRING, serving_size STRING,
states_tags tags, stores_tags tags, stores STRING, traces_tags tags, unique_scans_n INT,
unknown_ingredients_n INT, unknown_nutrients_tags tags, vitamins_tags tags,
with_non_nutritive_sweeteners INT, with_sweeteners INT, schema_version INT
"""

# --- fixed values: food columns the beauty dataset does not have -----------------
NOT_IN_BEAUTY = """
categories_properties ciqual_food_name_tags compared_to_category environmental_score_data
environmental_score_grade environmental_score_score environmental_score_tags food_groups_tags
ingredients_without_ciqual_codes_n ingredients_without_ciqual_codes new_additives_n
no_nutrition_data nova_group nova_groups_tags nova_groups nutriments nutriscore_grade
nutriscore_score with_non_nutritive_sweeteners with_sweeteners
""".split()

# --- fixed values: price, proof and location columns -----------------------------
PRICE_COLUMNS = """
id BIGINT, type STRING, product_code STRING, product_name STRING, category_tag STRING,
labels_tags tags, origins_tags tags, price DECIMAL(10,3), price_is_discounted BOOLEAN,
price_without_discount DECIMAL(10,3), discount_type STRING, price_per STRING, currency STRING,
location_osm_id BIGINT, location_osm_type STRING, location_id INT, date DATE, proof_id INT,
receipt_quantity FLOAT, owner STRING, source STRING, created TIMESTAMP, updated TIMESTAMP
"""
PROOF_COLUMNS = """
file_path STRING, mimetype STRING, type STRING, date DATE, currency STRING,
receipt_price_count INT, receipt_price_total DECIMAL(10,3), owner STRING, source STRING,
created TIMESTAMP, updated TIMESTAMP
"""
LOCATION_COLUMNS = """
type STRING, osm_display_name STRING, osm_tag_key STRING, osm_tag_value STRING,
osm_address_postcode STRING, osm_address_city STRING, osm_address_country STRING,
osm_address_country_code STRING, osm_lat DOUBLE, osm_lon DOUBLE, website_url STRING,
source STRING, created TIMESTAMP, updated TIMESTAMP
"""
# Checked on input but not carried into the price dataset.
PROOF_INPUT_ONLY = "image_thumb_path STRING"
LOCATION_INPUT_ONLY = "osm_id BIGINT, osm_type STRING, osm_name STRING"

# --- fixed values: ingredient fields, in the order they are written --------------
INGREDIENT_FIELDS = """
percent_max FLOAT, percent_min FLOAT, is_in_taxonomy INT, percent_estimate FLOAT, vegan STRING,
id STRING, text STRING, vegetarian STRING, ciqual_food_code STRING, percent FLOAT,
from_palm_oil STRING, ingredients LIST, ecobalyse_code STRING, processing STRING, labels STRING,
origins STRING, ecobalyse_proxy_code STRING, quantity STRING, quantity_g FLOAT,
ciqual_proxy_food_code STRING
"""

FLAVORS = ("food", "beauty")
LANGUAGE_FIELDS = ("ingredients_text", "product_name", "packaging_text", "generic_name")


@lru_cache
def ddl(columns: str) -> T.StructType:
    """Parse one of the column lists above."""
    for _ in range(2):  # @images refers to @size
        for name, text in NESTED.items():
            columns = columns.replace(name, text)
    return T.StructType.fromDDL(columns.replace(" tags", " ARRAY<STRING>"))


@lru_cache
def product_schema(flavor: str) -> T.StructType:
    """Output schema of a product dataset."""
    food = ddl(FOOD_COLUMNS)
    if flavor == "food":
        return food
    if flavor == "beauty":
        return T.StructType([f for f in food if f.name not in NOT_IN_BEAUTY])
    raise ValueError(f"unsupported flavor: {flavor}")


@lru_cache
def price_schema() -> T.StructType:
    """Output schema of the price dataset."""
    proofs = [T.StructField("proof_" + f.name, f.dataType) for f in ddl(PROOF_COLUMNS)]
    places = [T.StructField("location_" + f.name, f.dataType) for f in ddl(LOCATION_COLUMNS)]
    return T.StructType(ddl(PRICE_COLUMNS).fields + proofs + places)


@lru_cache
def ingredient_fields() -> list[tuple[str, str]]:
    """(name, kind) pairs; kind is FLOAT, INT, STRING or LIST."""
    return [tuple(part.split()) for part in INGREDIENT_FIELDS.replace("\n", " ").split(",")]
