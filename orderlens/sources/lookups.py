"""Lookup tables. Every entry here is a fixed value."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# Brazilian states: code, name, region.
STATES = (
    ("AC", "Acre", "North"),
    ("AL", "Alagoas", "Northeast"),
    ("AP", "Amapa", "North"),
    ("AM", "Amazonas", "North"),
    ("BA", "Bahia", "Northeast"),
    ("CE", "Ceara", "Northeast"),
    ("DF", "Distrito Federal", "Central-West"),
    ("ES", "Espirito Santo", "Southeast"),
    ("GO", "Goias", "Central-West"),
    ("MA", "Maranhao", "Northeast"),
    ("MT", "Mato Grosso", "Central-West"),
    ("MS", "Mato Grosso do Sul", "Central-West"),
    ("MG", "Minas Gerais", "Southeast"),
    ("PA", "Para", "North"),
    ("PB", "Paraiba", "Northeast"),
    ("PR", "Parana", "South"),
    ("PE", "Pernambuco", "Northeast"),
    ("PI", "Piaui", "Northeast"),
    ("RJ", "Rio de Janeiro", "Southeast"),
    ("RN", "Rio Grande do Norte", "Northeast"),
    ("RS", "Rio Grande do Sul", "South"),
    ("RO", "Rondonia", "North"),
    ("RR", "Roraima", "North"),
    ("SC", "Santa Catarina", "South"),
    ("SP", "Sao Paulo", "Southeast"),
    ("SE", "Sergipe", "Northeast"),
    ("TO", "Tocantins", "North"),
)
REGIONS = ("North", "Northeast", "Central-West", "Southeast", "South")

# Category key, spelled as the source spells it, and category group.
CATEGORY_GROUPS = (
    ("bed_bath_table", "Home & Furniture"),
    ("furniture_decor", "Home & Furniture"),
    ("housewares", "Home & Furniture"),
    ("office_furniture", "Home & Furniture"),
    ("kitchen_dining_laundry_garden_furniture", "Home & Furniture"),
    ("furniture_mattress_and_upholstery", "Home & Furniture"),
    ("furniture_living_room", "Home & Furniture"),
    ("furniture_bedroom", "Home & Furniture"),
    ("home_confort", "Home & Furniture"),
    ("home_comfort_2", "Home & Furniture"),
    ("la_cuisine", "Home & Furniture"),
    ("flowers", "Home & Furniture"),
    ("christmas_supplies", "Home & Furniture"),
    ("party_supplies", "Home & Furniture"),
    ("art", "Home & Furniture"),
    ("arts_and_craftmanship", "Home & Furniture"),
    ("computers_accessories", "Electronics & Computing"),
    ("computers", "Electronics & Computing"),
    ("electronics", "Electronics & Computing"),
    ("tablets_printing_image", "Electronics & Computing"),
    ("audio", "Electronics & Computing"),
    ("consoles_games", "Electronics & Computing"),
    ("cine_photo", "Electronics & Computing"),
    ("pc_gamer", "Electronics & Computing"),
    ("telephony", "Electronics & Computing"),
    ("fixed_telephony", "Electronics & Computing"),
    ("home_appliances", "Home Appliances"),
    ("home_appliances_2", "Home Appliances"),
    ("small_appliances", "Home Appliances"),
    ("air_conditioning", "Home Appliances"),
    ("small_appliances_home_oven_and_coffee", "Home Appliances"),
    ("portateis_cozinha_e_preparadores_de_alimentos", "Home Appliances"),
    ("health_beauty", "Health & Beauty"),
    ("perfumery", "Health & Beauty"),
    ("diapers_and_hygiene", "Health & Beauty"),
    ("fashion_bags_accessories", "Fashion & Accessories"),
    ("fashion_shoes", "Fashion & Accessories"),
    ("fashion_male_clothing", "Fashion & Accessories"),
    ("fashio_female_clothing", "Fashion & Accessories"),
    ("fashion_underwear_beach", "Fashion & Accessories"),
    ("fashion_sport", "Fashion & Accessories"),
    ("fashion_childrens_clothes", "Fashion & Accessories"),
    ("luggage_accessories", "Fashion & Accessories"),
    ("watches_gifts", "Fashion & Accessories"),
    ("sports_leisure", "Sports, Toys & Leisure"),
    ("toys", "Sports, Toys & Leisure"),
    ("baby", "Sports, Toys & Leisure"),
    ("musical_instruments", "Sports, Toys & Leisure"),
    ("music", "Sports, Toys & Leisure"),
    ("cds_dvds_musicals", "Sports, Toys & Leisure"),
    ("dvds_blu_ray", "Sports, Toys & Leisure"),
    ("construction_tools_construction", "Tools & Construction"),
    ("costruction_tools_garden", "Tools & Construction"),
    ("costruction_tools_tools", "Tools & Construction"),
    ("construction_tools_lights", "Tools & Construction"),
    ("construction_tools_safety", "Tools & Construction"),
    ("garden_tools", "Tools & Construction"),
    ("home_construction", "Tools & Construction"),
    ("signaling_and_security", "Tools & Construction"),
    ("security_and_services", "Tools & Construction"),
    ("books_technical", "Books & Stationery"),
    ("books_general_interest", "Books & Stationery"),
    ("books_imported", "Books & Stationery"),
    ("stationery", "Books & Stationery"),
    ("food_drink", "Food & Drink"),
    ("food", "Food & Drink"),
    ("drinks", "Food & Drink"),
    ("auto", "Auto & Industrial"),
    ("agro_industry_and_commerce", "Auto & Industrial"),
    ("industry_commerce_and_business", "Auto & Industrial"),
    ("pet_shop", "Other"),
    ("cool_stuff", "Other"),
    ("market_place", "Other"),
)

# Payment type, label, sort order.
PAYMENT_TYPES = (
    ("credit_card", "Credit card", 1),
    ("boleto", "Boleto", 2),
    ("voucher", "Voucher", 3),
    ("debit_card", "Debit card", 4),
)


def states(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(list(STATES), "state_code string, state_name string, region string")


def category_groups(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(list(CATEGORY_GROUPS), "category_en string, category_group string")


def payment_types(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(
        list(PAYMENT_TYPES), "payment_type string, payment_type_label string, sort_order int"
    )
