"""Source files of the question corpus and the names derived from them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

FILE_PREFIX = "amazon_pqa_"

# The category files of the corpus, without prefix and ending.
CATEGORY_STEMS = """
streaming_media_players headlight_bulbs t-shirts monitors in-dash_navigation routers tv_antennas
sports_water_bottles remote_controls headlight_&_tail_light_conversion_kits home_security_systems
games led_&_lcd_tvs smartwatches batteries jeans dolls vehicle_backup_cameras camcorders chairs
quadcopters_&_multirotors string_lights stands portable_bluetooth_speakers surveillance_dvr_kits
accessories video_projectors sunglasses floor_mats activity_&_fitness_trackers diffusers
bullet_cameras inkjet_printers receivers area_rugs over-ear_headphones mattresses headsets
traditional_laptops dome_cameras pumps sound_bars sports_&_action_video_cameras led_strip_lights
panels tablets memory costumes sheet_&_pillowcase_sets wrist_watches battery_chargers adapters
tv_ceiling_&_wall_mounts external_hard_drives cradles on-dash_cameras led_bulbs gun_holsters towers
code_readers_&_scan_tools keyboards graphics_cards earbud_headphones usb_cables power_converters
headlight_assemblies handheld_flashlights mp3_&_mp4_players cases posters_&_prints landline_phones
screen_protectors chargers_&_adapters home_office_desks sets slr_camera_lenses light_bars wigs masks
hair_extensions bed_frames car hidden_cameras motherboards consoles unlocked_cell_phones
amazon_echo_&_alexa_devices food_storage_&_organization_sets repellents usb_flash_drives
car_stereo_receivers casual basic_cases computer_cases backpacks fashion_sneakers pants beds
carrier_cell_phones in-dash_dvd_&_video_receivers
""".split()
CATEGORY_FILES = [f"{FILE_PREFIX}{stem}.json" for stem in CATEGORY_STEMS]
PASSAGE_DOMAINS = ["ecom", "video", "medical"]


def _replace_all(col: Column, pairs: list[tuple[str, str]]) -> Column:
    for old, new in pairs:
        col = F.replace(col, F.lit(old), F.lit(new))
    return col


def category_value(file_name: Column, prefix: str = FILE_PREFIX) -> Column:
    """``./amazon_pqa_led_&_lcd_tvs.json`` -> ``led and lcd tvs``."""
    return _replace_all(file_name, [("./", ""), (".json", ""), ("&", "and"), (prefix, ""), ("_", " ")])


def category_constant(file_name: Column) -> Column:
    """``./amazon_pqa_in-dash_navigation.json`` -> ``AMAZON_PQA_IN_DASH_NAVIGATION``."""
    return _replace_all(F.upper(file_name), [("./", ""), (".JSON", ""), ("&", "AND"), ("-", "_")])


def category_dimension(files: DataFrame, file_name: str = "file_name") -> DataFrame:
    return files.select(
        file_name, category_value(F.col(file_name)).alias("category_name"),
        category_constant(F.col(file_name)).alias("constant"))


def lookup_category(docs: DataFrame, dimension: DataFrame, column: str = "category_name",
                    on_unknown: str = "error") -> DataFrame:
    """Attach the constant of each category name.

    With ``on_unknown="error"`` a row of an unknown category fails the query with
    the offending name and the valid ones; ``"null"`` leaves the constant null.
    """
    joined = docs.join(dimension.select(F.col("category_name").alias(column), "constant"), column, "left")
    if on_unknown == "null":
        return joined
    quoted = F.concat(F.lit("'"), F.col("category_name"), F.lit("'"))
    valid = dimension.agg(F.array_join(F.array_sort(F.collect_set(quoted)), ", ")).scalar()
    message = F.concat(F.lit("Unknown category name "), F.coalesce(F.col(column), F.lit("null")), F.lit("\nValid names: "), valid)
    return joined.withColumn(
        "constant", F.when(F.col("constant").isNull(), F.raise_error(message).cast("string"))
        .otherwise(F.col("constant")))


def category_of_constant(docs: DataFrame, dimension: DataFrame, column: str = "constant") -> DataFrame:
    """Attach the category name of each constant, null for an unknown one."""
    return docs.join(dimension.select(F.col("constant").alias(column), "category_name"), column, "left")


def missing_sources(expected: DataFrame, found: DataFrame, on: str) -> DataFrame:
    return expected.join(found.select(on), on, "left_anti")


def present_sources(expected: DataFrame, found: DataFrame, on: str) -> DataFrame:
    return expected.join(found.select(on), on, "left_semi")
