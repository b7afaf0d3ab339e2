"""Words the data is written in.  Fixed values: results depend on them as they stand."""

from __future__ import annotations

DAMAGE_TYPES = ("scratch", "dent", "crack", "paint_chip", "puncture", "broken_light")
ZONES = ("front", "rear", "front_left", "front_right", "rear_left", "rear_right")
SIDE_ZONES = ("front_left", "front_right", "rear_left", "rear_right")
EXTENSIONS = ("small", "medium", "large")
SEVERITIES = ("leve", "moderado", "severo")
LANES = ("verde", "ambar", "rojo")
SPLITS = ("train", "val", "test")

#: Zone of a part; a part without one says nothing about the zone.
PART_ZONE = {
    "front_bumper": "front",
    "hood": "front",
    "front_glass": "front",
    "front_light": "front",
    "front_door": "front",
    "front_left_door": "front_left",
    "front_left_light": "front_left",
    "left_mirror": "front_left",
    "front_right_door": "front_right",
    "front_right_light": "front_right",
    "right_mirror": "front_right",
    "back_bumper": "rear",
    "trunk": "rear",
    "tailgate": "rear",
    "back_glass": "rear",
    "back_light": "rear",
    "back_door": "rear",
    "back_left_door": "rear_left",
    "back_left_light": "rear_left",
    "back_right_door": "rear_right",
    "back_right_light": "rear_right",
    "wheel": None,
    "object": None,
}
#: Parts whose zone does not tell the side.
SIDE_AGNOSTIC_PARTS = ("front_light", "front_door", "back_light", "back_door")

#: Category of a part.
PART_CATEGORY = {
    "front_bumper": "plastic_panel",
    "back_bumper": "plastic_panel",
    "hood": "body_panel",
    "trunk": "body_panel",
    "tailgate": "body_panel",
    "front_left_door": "body_panel",
    "front_right_door": "body_panel",
    "back_left_door": "body_panel",
    "back_right_door": "body_panel",
    "front_door": "body_panel",
    "back_door": "body_panel",
    "front_glass": "glass",
    "back_glass": "glass",
    "front_light": "light_assembly",
    "back_light": "light_assembly",
    "front_left_light": "light_assembly",
    "front_right_light": "light_assembly",
    "back_left_light": "light_assembly",
    "back_right_light": "light_assembly",
    "left_mirror": "mirror",
    "right_mirror": "mirror",
    "wheel": "wheel",
    "object": "unknown",
}

#: Label of a source -> damage type, None to leave the label out.
CLASS_MAP = {
    "Dent": "dent",
    "Scratch": "scratch",
    "Crack": "crack",
    "Lamp Broken": "broken_light",
    "Glass Shatter": None,
    "Tire Flat": None,
    "tray_son": "scratch",
    "mop_lom": "dent",
    "rach": "crack",
    "thung": "dent",
    "be_den": "broken_light",
    "mat_bo_phan": None,
    "vo_kinh": None,
    "dent": "dent",
    "scratch": "scratch",
    "crack": "crack",
    "broken_lamp": "broken_light",
    "broken_light": "broken_light",
    "flat_tire": None,
    "glass_shatter": None,
    "broken_glass": None,
    "tire_flat": None,
    "bonnet-dent": "dent",
    "door-dent": "dent",
    "panel-dent": "dent",
    "body-dent": "dent",
    "door-scratch": "scratch",
    "paint-scratch": "scratch",
    "paint_damage": "scratch",
    "bumper-crack": "crack",
    "broken_bumper": "crack",
    "broken-bumper": "crack",
    "headlight": "broken_light",
    "taillight": "broken_light",
    "broken-headlight": "broken_light",
    "broken-taillight": "broken_light",
    "damage": None,
    "Damage": None,
    "minor": "scratch",
    "moderate": "dent",
    "severe": "crack",
}
#: Parts of a label that leave it out.
EXCLUDED_PATTERNS = ("tire", "tyre", "flat", "glass", "windshield", "window", "luna", "cristal", "parabrisas")

#: Word of a description -> parts it may mean.
KEYWORD_PARTS = {
    "paragolpes": ("front_bumper", "back_bumper"),
    "parachoques": ("front_bumper", "back_bumper"),
    "puerta": ("front_left_door", "front_right_door", "back_left_door", "back_right_door"),
    "faro": ("front_left_light", "front_right_light"),
    "piloto": ("back_left_light", "back_right_light"),
    "retrovisor": ("left_mirror", "right_mirror"),
    "espejo": ("left_mirror", "right_mirror"),
    "capo": ("hood",),
    "aleta": ("body_panel",),
    "guardabarros": ("body_panel",),
    "llanta": ("wheel",),
    "rueda": ("wheel",),
    "porton": ("tailgate",),
    "maletero": ("trunk", "tailgate"),
}

#: Coarse label -> fine labels it may be.
COARSE_TO_FINE = {
    "dent": ("dent", "puncture"),
    "scratch": ("scratch", "paint_chip"),
    "crack": ("crack",),
    "broken_light": ("broken_light",),
    "Damage": ("scratch", "dent", "crack", "paint_chip", "puncture", "broken_light"),
}
