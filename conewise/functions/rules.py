"""Fixed values the shop's reports depend on.

Fixed values: these lists must stay equal to the source system's business
rules for the results to agree.  They are kept here, in natural order, and
passed as parameters to the column builders in ``conewise.functions.columns``.
"""

# --- Expense categories: lower(trim(category)) -> normalised name; default 'Otros'.
EXPENSE_CATEGORY_MAP = {
    "insumos": "Insumos",
    "alimentos": "Insumos",
    "logistica": "Logistica",
    "inversion": "Inversion",
    "marketing": "Marketing",
    "mod": "Mano de obra",
    "mod jorge": "Mano de obra",
    "materiales y herramientas": "Materiales y herramientas",
    "servicios": "Servicios",
    "inscripción": "Inscripciones",
    "inscripciones": "Inscripciones",
    "seguridad": "Seguridad",
    "impuestos": "Impuestos",
    "etiquetas bedual": "Etiquetas",
    "alquiler": "Alquiler",
    "bromatologia": "Bromatologia",
    "fumigacion": "Fumigacion",
    "potes": "Potes",
    "socios": "Socios",
    "comisiones": "Comisiones",
    "pago": "Pago",
    "indirecto": "Indirecto",
    "general": "General",
    "feria": "Feria",
    "otros": "Otros",
    "familia": "Otros",
    "licor": "Otros",
    "coche": "Otros",
    "taxi": "Otros",
    "suministros del hogar": "Otros",
    "seguro": "Otros",
    "electricidad": "Servicios",
    "ultimo cargado": "Otros",
}
EXPENSE_CATEGORY_DEFAULT = "Otros"

# --- Expense means of payment: lower(trim(x)) -> normalised; default 'otro'.
EXPENSE_MEANS_MAP = {
    "efectivo": "efectivo",
    "tc": "tarjeta_credito",
    "tc mc": "tarjeta_credito",
    "tc visa": "tarjeta_credito",
    "mp": "mercadopago",
}
EXPENSE_MEANS_DEFAULT = "otro"

# --- Product weight ladder, first match wins.  Each rule: (patterns, kg).
# Patterns are LIKE patterns on lower(name), except entries marked "exact",
# which compare the name as typed (a LIKE without wildcards).
WEIGHT_LADDER = [
    (["%pack 5 cucuruch%"], 0.0),
    (["%pack 4 cucuruch%"], 0.0),
    (["%4 de 1/2%"], 2.0),
    (["%3 de 1/4%"], 0.75),
    (["%1kg + 1/2%"], 1.5),
    (["%2 x 1/4%"], 0.5),
    (["%1/2 kg%", "%1/2kg%"], 0.5),
    (["%1/4 kg%", "%1/4kg%"], 0.25),
    (["%3/4 kg%", "%3/4kg%"], 0.75),
    ([("exact", "1 KG"), "1kg%", "%promo 1kg%", "%promo 1 kg%"], 1.0),
    (["%capelina%"], 0.25),
    (["%vasito%"], 0.1),
    (["%cucuruch%"], 0.2),
]
WEIGHT_DEFAULT = 0.0

# --- Pot price tiers by product kg (current prices); cones, cups and capelinas use none.
POT_EXCLUDED = ["%cucuruch%", "%vasito%", "%capelina%"]
POT_TIERS = [(0.25, 250), (0.5, 350), (0.75, 450), (1.0, 550), (1.5, 750), (2.0, 950)]
POT_DEFAULT = 550
BAG_COST = 100

# --- Order status names.
STATUS_NAMES = {1: "Pendiente", 2: "En preparación", 3: "Entregado", 4: "Cancelado"}
STATUS_DEFAULT = "Otro"
STATUS_DELIVERED = 3
STATUS_CANCELLED = 4

# --- Southern-hemisphere seasons by month.
SEASONS = [
    ("Verano", [12, 1, 2]),
    ("Otoño", [3, 4, 5]),
    ("Invierno", [6, 7, 8]),
    ("Primavera", [9, 10, 11]),
]

# --- Commercial seasons: two definitions exist.  Orders and daily sales:
COMMERCIAL_SEASON_ORDERS = [("Alta", [11, 12, 1]), ("Baja", [5, 6, 7])]
# ... customer cohorts:
COMMERCIAL_SEASON_COHORTS = [("Alta", [11, 12, 1, 2]), ("Baja", [4, 5, 6, 7, 8])]
COMMERCIAL_SEASON_DEFAULT = "Media"

# --- Dayparts by hour (inclusive bounds).
DAYPARTS = [("Mediodia", 10, 13), ("Tarde", 14, 17), ("Noche", 18, 21), ("Trasnoche", 22, 23)]
DAYPART_DEFAULT = "Otro"

# --- RFM bands.
RECENCY_BANDS = [(30, 7), (60, 6), (90, 5), (180, 4), (360, 3), (720, 2)]  # days <= bound -> score
RECENCY_DEFAULT = 1
FREQUENCY_BANDS = [(1.0, 6), (0.25, 5), (0.1, 4), (0.05, 3), (0.01, 2)]  # orders/week >= bound -> score
FREQUENCY_DEFAULT = 1

RECENCY_LABELS = {7: "0-30 dias", 6: "31-60 dias", 5: "61-90 dias", 4: "91-180 dias",
                  3: "181-360 dias", 2: "361-720 dias", 1: "720+ dias"}
FREQUENCY_LABELS = {6: "1+ /semana", 5: "~quincenal", 4: "~mensual", 3: "~bimestral",
                    2: "~semestral", 1: "<semestral"}
VOLUME_LABELS = {5: "Q5 (top KG)", 4: "Q4", 3: "Q3", 2: "Q2", 1: "Q1 (bajo KG)"}
NO_PURCHASE_LABEL = "Sin compras"

# --- Weather quintile labels (1..5).
TEMPERATURE_LABELS = ["Muy frio", "Frio", "Templado", "Calido", "Muy calido"]
RAIN_LABELS = ["Sin lluvia", "Lluvia leve", "Lluvia moderada", "Lluvia fuerte", "Lluvia intensa"]
WIND_LABELS = ["Calma", "Brisa", "Viento moderado", "Viento fuerte", "Viento muy fuerte"]

# --- Business parameters.
PLATFORM_COMMISSION = 0.30   # share of platform sales kept by the platform
COURIER_SURCHARGE = 1.20     # courier invoice times this = delivery cost
RETENTION_HORIZONS = (30, 60, 90)
FLAVOUR_PRICE_MULTIPLIER = 3  # estimated income per kg = cost per kg x 3
CATCH_ALL_CUSTOMERS = [0, 1]  # not used as a source of order phones

# --- Pickup and payment codes used in breakdowns.
PICKUPS = [("delivery", "delivery"), ("local", "local"), ("mostrador", "mostrador")]
PAYMENTS = [("efectivo", "cash"), ("mercadopago", "mp"), ("transferencia", "transfer")]

# --- Expense groups in the monthly P&L.
PNL_SUPPLY_CATEGORIES = ["Insumos", "Potes"]
PNL_NAMED_CATEGORIES = [
    ("gasto_mano_obra", "Mano de obra"),
    ("gasto_alquiler", "Alquiler"),
    ("gasto_servicios", "Servicios"),
    ("gasto_marketing", "Marketing"),
    ("gasto_impuestos", "Impuestos"),
    ("gasto_logistica", "Logistica"),
]
PNL_INVESTMENT = "Inversion"

# --- Cash-flow outflow means.
CASH_OUT_MEANS = [("egresos_efectivo", "efectivo"), ("egresos_tarjeta", "tarjeta_credito"),
                  ("egresos_mp", "mercadopago"), ("egresos_otro", "otro")]

# --- Customer segments, evaluated in order; each rule is (label, [(value, side, bound)])
# over days since the last order, number of orders and the three scores.
SEGMENT_NO_PURCHASE = "Sin compras"
SEGMENT_RULES = [
    ("Nuevo", [("days", "<=", 30), ("orders", "<=", 2)]),
    ("VIP", [("r", ">=", 6), ("f", ">=", 5), ("m", ">=", 4)]),
    ("Leal", [("r", ">=", 5), ("f", ">=", 4)]),
    ("Potencial", [("r", ">=", 5), ("m", ">=", 3), ("f", "<=", 3)]),
    ("En riesgo", [("r", "<=", 3), ("f", ">=", 4)]),
    ("Dormido", [("r", "<=", 2), ("f", ">=", 3)]),
    ("Perdido", [("r", "<=", 2), ("f", "<=", 2)]),
]
SEGMENT_DEFAULT = "Ocasional"

# --- Retention columns and the labels that reports show for them.
RETENTION_LABELS = {"retencion_30d_pct": "30 dias", "retencion_60d_pct": "60 dias", "retencion_90d_pct": "90 dias"}
