"""Vocabularies and rule tables of the reports.

Every constant below is a fixed value: results only agree with the reports when
these words, patterns and numbers are used as they stand.  Lists of people,
sellers or owners are not kept here; operators take those as tables.
"""

# Size classes, small to large.
SIZES = ("XS3", "XS2", "XS", "S", "M", "LO", "L", "XL", "XXL", "O", "EO")

# Half-open range [lo, hi) of each measure per size class.
SIZE_RANGES = {
    "weight": {
        "XS3": (0, 0.5), "XS2": (0.5, 1), "XS": (1, 3), "S": (3, 10), "M": (10, 20), "LO": (10, 20),
        "L": (20, 30), "XL": (30, 50), "XXL": (50, 100), "O": (100, 300), "EO": (300, 99999),
    },
    "volume_m3": {
        "XS3": (0, 0.005), "XS2": (0.005, 0.009), "XS": (0.009, 0.032), "S": (0.032, 0.18),
        "M": (0.18, 0.33), "LO": (0.18, 0.33), "L": (0.33, 0.66), "XL": (0.33, 0.66),
        "XXL": (0.66, 1), "O": (1, 2.5), "EO": (2.5, 99999),
    },
    "length": {
        "XS3": (0, 40), "XS2": (0, 40), "XS": (0, 40), "S": (0, 40), "M": (40, 100), "LO": (100, 650),
        "L": (100, 240), "XL": (100, 240), "XXL": (240, 650), "O": (240, 650), "EO": (650, 99999),
    },
}

# Television class by screen inches (lo, hi], the first range also holds its lower end.
TV_CATEGORY = "G19080602"
TV_INCHES = (("M", 19, 32), ("LO", 32, 55), ("L", 55, 65), ("XL", 65, 75), ("XXL", 75, 90))
TV_KEEP = ("XS3", "XS2", "XS")

# Shipping tariff by size and price; (sizes, from price, to price, fee).
TARIFF_1 = (
    (None, None, 79, 0.9),
    (("XXXS", "XXS", "XS", "S"), 79, None, 6.9),
    (("M", "LO", "L"), 79, None, 8.9),
    (("XL", "XXL", "O", "EO"), 79, None, 19.9),
)
TARIFF_2 = (
    (("XXXS", "XXS", "XS", "S"), None, 99, 1.0),
    (("M", "LO"), None, 99, 4.9),
    (("L", "XL", "XXL", "O", "EO"), None, 99, 6.9),
    (("XXXS",), 99, None, 5.9),
    (("XXS", "XS"), 99, None, 6.9),
    (("S", "M", "LO", "L"), 99, None, 9.9),
    (("XL", "XXL"), 99, None, 15.9),
    (("O", "EO"), 99, None, 19.9),
)

# Order-item states and milestones.
ORDER_STATUSES = (
    "handled_by_marketplace", "packed_by_marketplace", "item_received", "awaiting_fulfillment",
    "ready_to_ship", "shipped", "picked", "delivered", "canceled", "failed_delivery", "failed",
    "return_shipped_by_customer", "return_waiting_for_approval", "return_rejected", "returned",
)
MILESTONES = {
    "created_at": ("created_at", "time_handled_by_marketplace", "time_item_received",
                   "time_awaiting_fulfillment", "time_packed_by_marketplace"),
    "ready_to_ship": ("time_ready_to_ship", "time_picked"),
    "shipped_at": ("time_ingress", "time_shipped"),
    "terminated_at": ("time_delivered", "time_canceled", "time_failed_delivery", "time_failed"),
    "return_shipped_by_customer": ("time_return_shipped_by_customer", "time_return_to_seller"),
}
FIRST_TIME_STATUSES = ("delivered",)

# Backlog action by days late, first match wins: (lo, hi, label), both ends included.
BACKLOG_ACTIONS = (
    (30, None, "Cambio de estado"),
    (4, 29, "Cancelar"),
    (3, 3, "Comunicar 3er refuerzo"),
    (2, 2, "Comunicar 2do refuerzo"),
    (1, 1, "Comunicar 1er refuerzo"),
    (0, 0, "A tiempo"),
    (-1, -1, "Comunicar envío día siguiente"),
    (None, -2, "No accionar"),
)
BACKLOG_SILENT = ("Cancelar", "Cambio de estado", "No accionar", "Comunicar envío día siguiente")
BACKLOG_DELAY_TEXT = {
    "A tiempo": "A tiempo",
    "Comunicar 1er refuerzo": "1 dia de retraso",
    "Comunicar 2do refuerzo": "2 dias de retraso",
    "Comunicar 3er refuerzo": "3 dias de retraso",
}
BACKLOG_OPEN_STATES = ("handled_by_marketplace", "packed_by_marketplace", "ready_to_ship",
                       "awaiting_fulfillment", "item_received", "picked")

# Ledger measure -> (transaction types paid back, transaction types charged).
LEDGER_CHARGES = {
    "cobro_comision": (("COMMISSION_CREDIT", "COMMISSION_CREDIT_ADJUSTMENT"), ("COMMISSION", "COMMISSION_ADJUSTMENT")),
    "cobro_ou": (("PROMO_ITEM_PRICE_CREDIT", "PROMO_ITEM_PRICE_CREDIT_ADJUST"),
                 ("PROMO_ITEM_PRICE", "PROMO_ITEM_PRICE_ADJUST")),
    "cobro_cofilog": (("FREE_SHIPPING_SELLER_COST_CREDIT", "FREE_SHIPPING_SELLER_COST_CREDIT_ADJUSTMENT"),
                      ("FREE_SHIPPING_SELLER_COST", "FREE_SHIPPING_SELLER_COST_ADJUSTMENT")),
    "cobro_logrep": (("LOGISTICS_REPROCESS_FEE_CREDIT",), ("LOGISTICS_REPROCESS_FEE",)),
    "cobro_revlog": (("REVERSE_LOGISTICS_FEE_CREDIT",), ("REVERSE_LOGISTICS_FEE",)),
    "cobro_loginv": (("SHIPPING_FEE_RETURN_CREDIT",), ("SHIPPING_FEE_RETURN",)),
    "cobro_loginv_item": (("SHIPPING_FEE_ITEM_LEVEL_CREDIT", "SHIPPING_FEE_ITEM_LEVEL_CREDIT_ADJU"),
                          ("SHIPPING_FEE_ITEM_LEVEL", "SHIPPING_FEE_ITEM_LEVEL_ADJU")),
    "cobro_loginv_ajuste": (("SHIPPING_FEE_CREDIT_ADJUST",), ("SHIPPING_FEE_ADJUST",)),
    "cobro_ship_fby": ((), ("SHIPPING_FEE_FBY",)),
    "cobro_inb_fby": ((), ("INBOUND_FEE_FBY",)),
    "cobro_invrem_fby": ((), ("INVENTORY_REMOVAL_FEE_FBY_CREDIT",)),
    "cobro_logrep_fby": ((), ("LOGIS_REW_REPRO_FEE_FBY",)),
    "cobro_cancel": (("CANCELLATION_FEE_CREDIT",), ("CANCELLATION_FEE",)),
    "cobro_handling_fee": ((), ("HANDLING_FEE_ITEM_LEVEL_ADJUSTMENT",)),
    "cobro_vas": (("SPONSORED_PRODUCTS_CREDIT",), ("SPONSORED_PRODUCTS",)),
    "cobro_medios": (("MEDIA_MANAGEMENT_ONLINE_CREDIT",), ("MEDIA_MANAGEMENT_ONLINE",)),
    "cobro_banner": (("BANNERS_ON_CREDIT",), ("BANNERS_ON",)),
    "cobro_banner_home": ((), ("BANNERS_HOME",)),
    "cobro_mailings": ((), ("MAILINGS",)),
    "cobro_flex": (("FLEX_CREDIT",), ("FLEX",)),
    "cobro_apelacion": (("APPEALED_RETURN_CREDIT",), ("APPEALED_RETURN",)),
}
LEDGER_PAYMENT = ("ITEM_PRICE_CREDIT",)
LEDGER_DISCOUNT = ("ITEM_PRICE",)
LEDGER_ADJUSTMENT = ("APPEALED_RETURN_CREDIT", "LOST_OR_DAMAGED_ORDER_ITEM_LEVEL", "LOST_OR_DAMAGED_ORDER_ITEM_LEVEL_CREDIT")
INCOME_EVENTS = (("PAYMENT", "ORDERLINE"), ("CHARGED",))
OUTFLOW_EVENTS = (("CANCELLATION", "RETURN"), ("CANCELLED", "RECEIVED", "REJECTED"))

# Final states per source, used for the recommended action.
CLOSED_STATES = {
    "status_order": (("delivered",), ("canceled", "failed")),
    "status_platform": (("DELIVERED",), ("CANCELLED", "UNDELIVERED")),
    "status_tms": (("Entregado",), ("Anulado", "Devolucion Al Shipper", "Fallo De Entrega", "Retorno A Seller", "Siniestro")),
    "status_store": (("DELIVERED",), ("ANNULLED", "CANCELLED")),
}

# Reverse-logistics carrier states -> one vocabulary.
RETURN_STATES = {
    "Custodia": ("CUSTODIA", "CUSTODIA DE OPL", "EN DEVOLUCION"),
    "En Almacén": ("DISPONIBLE PARA RETIRO", "ADMITIDO EN HUB", "EN BODEGA CROSSDOCK", "IMPO (SE QUEDA EN QOLQAS)",
                   "AVAILABLE_FOR_PICKUP"),
    "En Reparto": ("DESPACHADO A DESTINO", "REINGRESO", "EN REPARTO", "SALIO A RUTA", "EN PROCESO DE ENTREGA",
                   "ARRIBADO EN DESTINO", "EN TRANSITO A ORIGEN", "EN TRANSITO BODEGA OL", "TRANSITO LOCAL",
                   "EXCEPCION DE ENTREGA", "VISITADO SIN ENTREGA", "DELIVERY_ATTEMPTED", "IN_TRANSIT", "ON_ROUTE",
                   "OUT_FOR_DELIVERY", "SHIPMENT_LOADED"),
    "En Tienda": ("ENTREGADO EN TIENDA",),
    "Entregado": ("ENTREGADO", "RETORNO A SELLER", "ENTREGADO AL SELLER", "DEVOLUCION AL SHIPPER", "DELIVERED"),
    "Fallo de Entrega": ("FALLO DE ENTREGA", "FALLO DE ENTREGA CT"),
    "Registrado": ("SOLICITUD DE SERVICIO", "REGISTRADO", "RECEPCION", "PENDING", "RECEIVED"),
    "Siniestro": ("ENVIO SINIESTRADO", "SINIESTRO", "SINIESTRO DE OPL"),
    "Anulado": ("ANULADO", "MAL DESPACHO", "ANNULLED"),
}
RETURN_STATE_RANK = {
    "Entregado": 1, "Custodia": 1, "Siniestro": 1, "En Reparto": 2, "En Almacén": 2,
    "Excepcion de Entrega": 3, "Registrado": 4,
}
RETURN_STATE_RANK_OTHER = 5

# Appeal outcome, acceptance bands, return motive.
APPEAL_REJECT_SUBJECT = "Necesitamos mas informacion|Aviso cierre caso"
APPEAL_ACCEPT_TEXT = (
    "emitir la factura|se procedera a aceptar|de acuerdo a la evidencia brindada estaremos procediendo con aceptar "
    "su solicitud de rechazo|caso se encuentra cerrado"
)
ACCEPTANCE_BANDS = ((0.05, "1. 0 a 5%"), (0.30, "2. 5 a 30%"), (0.50, "3. 30% a 50%"), (1.0, "4. 50% a 100%"), (None, "5. 100%"))
RETURN_MOTIVES = {
    "Arrepentimiento": ("Cambio de parecer", "Lo encontre a mejor precio", "Me arrepenti y ya no lo quiero",
                        "Me equivoque de tamano color o modelo"),
    "Falla de funcionamiento": ("Garantia", "Tiene una falla de funcionamiento"),
    "Problemas con calidad del producto": (
        "Cambio de producto", "Error de talla", "Fuera de cobertura",
        "La entrega se atraso y ya no necesito el producto",
        "Las caracteristicas no coinciden con las de la publicacion",
        "Llego en mal estado o tiene dano estetico", "Llego un producto distinto al que compre",
        "Producto incompleto", "Publicidad enganosa"),
}
RETURN_MOTIVE_OTHER = "No identificado"

# Reason of a return by words in the case text, first match wins.
RETURN_REASONS = (
    (r"me equivoque de tamano color o modelo", "Me equivoque de tamano color o modelo"),
    (r"las caracteristicas no coinciden con las de la publicacion|las caracteristicas no corresponden|no es lo que esperaba",
     "Las caracteristicas no coinciden con las de la publicacion"),
    (r"tiene una falla de funcionamiento|no funciona|falla|fallas|fallado|defectuoso|defecto|no enciende|bloqueado|mal funcionamiento|danado|defectuosa",
     "Tiene una falla de funcionamiento"),
    (r"me llego un producto distinto al que compre|otro producto|entrega incorrecta|producto no corresponde|producto diferente|producto incorrecto|producto distinto|producto incorrecto|producto equivocado|producto que no corresponde|modelo diferente|diferente modelo",
     "Llego un producto distinto al que compre"),
    (r"me arrepenti y ya no lo quiero", "Me arrepenti y ya no lo quiero"),
    (r"llego en mal estado o tiene dano estetico|dano estetico|falla estetica|mal estado|roto|rota|malas condiciones",
     "Llego en mal estado o tiene dano estetico"),
    (r"esta incompleto|incompleto|incompleta|le falta|me falto|\bfaltante\b|\bllego sin\b|\ble llego\b", "Producto incompleto"),
    (r"lo encontre a mejor precio", "Lo encontre a mejor precio"),
    (r"la entrega se atraso y ya no necesito el producto|retraso|retrasado|courrier deleyed",
     "La entrega se atraso y ya no necesito el producto"),
    (r"el empaque original llego danado", "Empaque danado"),
    (r"cambio de parecer", "Cambio de parecer"),
    (r"entrega no reconocida|siniestro", "Entrega no reconocida"),
    (r"\btalla\b|tamano|no le queda|no me quedaron", "Error de talla"),
    (r"garantia", "Garantia"),
    (r"falsa entrega", "Falsa entrega"),
    (r"direccion incorrecta", "Direccion incorrecta"),
    (r"cliente ausente", "Cliente ausente"),
    (r"fuera de horario", "Fuera de horario"),
    (r"fuera de cobertura|domicilio sin acceso", "Fuera de cobertura"),
    (r"\breprogramacion\b", "Cliente solicito reprogramacion"),
    (r"doble|duplicado|duplicidad", "Compra duplicada"),
    (r"publicidad enganosa|\benganosa\b", "Publicidad enganosa"),
    (r"\btercera persona\b|\botra persona\b|autorizar tercero|\btercero\b", "Entrega a tercero"),
    (r"problema de cobro", "Problema de cobro"),
    (r"cambio|cambiar", "Cambio de producto"),
    (r"envio de boleta|envio de factura|\bboleta\b|\bfactura\b", "Envio de comprobante"),
)
RETURN_REASON_OTHER = "Otro"

# Outcome of a claim by words in each team's comment, first match wins.
CLAIM_RULES_SUPPORT = (
    (r"pedido entregado|compra entregada|orden entregada|tms entregado|se verifica entrega|seller confirma entrega|cliente confirma entrega|orden fue entregada|cliente acepto la entrega|seller se comunico con nosotros y nos menciona que ya realizo la entrega al cliente",
     "Pedido entregado al cliente"),
    (r"cliente no respond[a-z]{1,2}|cliente sin exito|falta de respuesta del cliente|no hubo confirmacion del cliente|cliente no contesta|no recibir respuesta de parte del cliente|cliente no contesta|cl no responde correo|cl no contesta|cliente no ha respondido|sin respuesta por parte de[a-z]{0,1} cliente|falta de respuesta del cl|falta de contacto con el cliente|se llama sin exito al cliente",
     "Cliente no responde"),
    (r"improcedente|reclamo no corresponde|cliente no mando evidencia|no envia evidencia|no fue facilitada la evidencia|cliente no ha enviado las evidencias|falta de evidencia por parte de cliente|reclamo no procede",
     "Caso improcedente o sin evidencias"),
    (r"no haber respuesta por parte del seller|al haber excedido el plazo de respuesta por parte del seller|habiendo superado el tiempo para que el seller de una solucion|no tener rpta del seller|seller no brind[a-z]{1,2} rpta|sin respuesta de seller|sin respuesta por parte de seller|falta de respuesta de seller|falta de respuesta por parte del seller|seller no respond[a-z]{1,2}|seller excede tiempo de respuesta|no hay respuesta de seller|no hay respuesta de parte de seller|seller no ha respondido|seller no se contacto|seller no se volvio a contactar|falta de respuesta seller|falta de respuesta del seller|seller no ha dado respuesta|no se tuvo respuesta por parte del seller|seller sin exito|seller excede el tiempo de respuesta|proveedor no contacto|proveedor de la compra no respondio|no se obtiene respuesta de seller|seller se puso en contacto pero cliente indica que no|no se obtuvo respuesta de seller|al no haber respuesta del seller|proveedor no respondio|no hubo respuesta por parte de seller|falta de respuesta del sx|no existe respuesta por parte de proveedor|senala que seller no se comunico",
     "Seller no responde"),
    (r"hd indica proceder a favor del cl|hd proceder a favor del cliente|hd se procede a favor del cliente|hd se crea caso de reembolso|hd se procede a crear|hd se procede a favor del cliente|se crea caso de reembolso con aprobacion de hd|cargo a hd|entregado sin evidencia|error del opl|evidencia tms no existe|evidencia tms ilegible",
     "Error de OPL"),
    (r"autorizacion de sx|seller responde e indica que se proceda a favor del cliente|seller solicita proceder a favor del cl|seller indica proceder con reembolso|seller indica proceder a favor del cl|seller menciona proceder a favor del cl|sin sustento seller|sx indica a favor del cl|sx se procede a favor del cliente|seller indica reembolsar|sx proceder a favor de[a-z]{0,1} cl|sx proceder con reembolso|seller no cumplio|falta de stock|no contar con stock|no tener stock|sx indica procede a favor del cl|seller indica que no realizo el envio|no cuenta con stock|seller indica que no realizo el envio|con aprobacion de sx|seller confirma producto faltante|seller indica que se proceda con la devolucion|seller indica que no tiene evidencia|seller en[a-z]{1,2}a evidencia|seller respondio indicando que se proceda con el reembolso|seller responde correo e indica que se proceda a favor del cliente|seller nos informa que no cuentan con stock|seller no podra atender al cliente|seller da respuesta se proceda a favor de cliente|seller indica proceder al reembolso|seller confirma envio de pedido incompleto|seller no despacho|seller indica que no cuenta con el stock",
     "Error de seller"),
    (r"cliente realizar la devolucion|cliente devolvera el producto incorrecto", "Producto devuelto por el cliente"),
    (r"mediacion", "Caso cerrado por mediacion"),
)
CLAIM_RULES_AFTERSALES = (
    (r"devuelto al seller", "Devuelto a seller"),
    (r"no fue entregado a cliente|cliente no cuenta con pedido|no se entregara a cliente|pedido no logro ser entregado",
     "Pedido no entregado a cliente"),
    (r"opl tiene el pedido en su poder|opl no logr[a-z]{1,2} realizar pedido|opl no logro regularizar entrega de pedido|opl no cuenta con sustento|opl senala que por error|opl marco por error|opl no cuenta con las evidencias|opl no cuenta con evidencias|no brindo los sustentos|opl confirma proceder a|opl confirma se proceda|opl no cuenta con evidencias de entrega|transporte indica proceder a favor de cliente|opl no cuenta con los sustentos de entrega|opl no presenta sustento|opl no logro realizar la entrega cliente",
     "Error de OPL"),
    (r"opl no responde|opl no brind[a-z]{0,1}|opl no brind[a-z]{0,1} respuesta|opl sin rpta|sin rpta|transportista no brinda respuesta|no brinda respuesta|encargado no brind[a-z]{0,1} rpta ni sustento",
     "OPL no responde"),
    (r"segun despacho seller|segun despacho de[a-z]{0,1} seller|segun el despacho de[a-z]{0,1} seller", "Flujo OPL sin errores"),
    (r"siniestro|siniestrado", "Siniestro OPL"),
    (r"falta de respuesta del seller", "Seller no responde"),
)
CLAIM_RULES_SELLER_TEAM = (
    (r"seller indica por correo que se proceda a favor del cliente|proceda a favor del cliente|proceder a favor del cliente|proceder a favor de cliente con reembolso|favor de[a-z]{0,1} cliente|proceda con reembolso|proceder con reembolso",
     "Error de seller"),
    (r"se le notific[a-z]{0,1} al seller", "Notificacion a seller"),
    (r"seller no respond[a-z]{0,4}|no brind[a-z]{1,2} respuesta", "Seller no responde"),
)
CLAIM_RULES_CLOSING = (
    (r"devuelto al seller", "Devuelto a seller"),
    (r"opl tiene el pedido en su poder|opl no logr[a-z]{1,2} realizar pedido", "Error de OPL"),
    (r"opl no responde|opl no brind[a-z]{0,1}|opl no brind[a-z]{0,1} respuesta|opl sin rpta|sin rpta|transportista no brinda respuesta",
     "OPL no responde"),
    (r"segun despacho seller|segun despacho de[a-z]{0,1} seller|segun el despacho de[a-z]{0,1} seller", "Flujo OPL sin errores"),
    (r"siniestro|siniestrado", "Siniestro OPL"),
)
CLAIM_NOT_DECISIVE = {"sx": "Notificacion a seller", "aftersales": "Flujo OPL sin errores"}
CLAIM_LATE_REFUND = "Reembolso fuera de plazo"
CLAIM_SILENT_SELLER = "Seller no responde"
CLAIM_SYSTEM_ERROR = "Error sistemico"
CLAIM_AGEING = ((("Longtail", "Nuevo", "Sin venta"), 30), (("Midtail", "AAA"), 120))

# Withholding concepts by words in the description, first match wins.
WITHHOLDING_CONCEPTS = (
    ("shipping fee", "Shipping Fee"),
    ("free ship", "Free Ship"),
    ("commission", "Commission"),
    ("mktg", "Mktg"),
    ("cancellation", "Cancellation"),
    ("pe_promo_item_price", "pe_promo_item_pric"),
    ("consignment", "Consignment"),
    ("logistics rework", "Logistics rework"),
)
WITHHOLDING_OTHER = "NA"
WITHHOLDING_MINIMUM = 699

# Mentions of an order in a case: (column, pattern).
ORDER_MENTIONS = (
    ("external_id", r"2[0-9]{8,9}$"),
    ("description", r"2[0-9]{8,9}$"),
    ("description", r"\b2[0-9]{1,9}\b"),
)

# Pieces of a node name.
NODE_NAME = {
    "delivery_method": r"^([^ ]+)",
    "n_delivery_method": r"^[^ ]+ (\d+)",
    "dts": r"DTS (\d+)",
    "cot": r"\b(\d{2}:\d{2})\b",
    "frequency": r"\d{2}:\d{2}\s+(.*)",
}
NODE_DELIVERY_TYPE = {"HOME_DELIVERY": ("DR-IBIS", "IBIS"), "COLLECT": ("C&C",)}
NODE_SELLER = r"-(SC\w{5})"

# Attribute keys of a product document, in order of preference.
SCREEN_KEYS = ("258", "724", "844", "1138", "1379", "1434", "1703")
WIDTH_KEYS = ("48", "55", "60", "72", "344", "375", "514", "548", "730", "762", "938", "962", "1082", "1210", "1295", "1314",
              "1333", "1405", "1431", "1495", "1719", "10794")
MODEL_KEY = "32"
SCREEN_CATEGORY_IDS = ("G19020305", "G19080602")

# Weekday marks inside a work-days text.
WEEKDAY_MARKS = {"monday": "Mon", "tuesday": "Tue", "wednesday": "Wed", "thursday": "Thu",
                 "friday": "Fri", "saturday": "Sat", "sunday": "Sun"}
LENGTH_KEYS = ("21", "28", "33", "90", "117", "365", "512", "527", "713", "779", "937", "1002", "1135", "1208", "1315",
               "1340", "1387", "1436", "1514", "1729", "10793", "11186")
HEIGHT_KEYS = ("34", "41", "47", "81", "311", "360", "490", "566", "740", "768", "848", "977", "1050", "1300", "1341",
               "1377", "1458", "1516", "1732", "10779", "10795")
WEIGHT_KEYS = ("8", "11", "14", "278", "392", "447", "606", "908", "1108", "1163", "1306", "33438")
PIECES_KEYS = ("245", "674", "761", "818", "1017", "1144", "1235", "34829", "39141")
PACKS_KEYS = ("10210", "10585", "10587", "10588", "10590", "10592", "10596", "10604", "10607", "11122", "11124", "11126", "22760", "31239")
CONDITION_KEYS = ("22",)
CONDITION_DETAIL_KEYS = ("49",)
SELLER_WARRANTY_KEYS = ("10206",)
WARRANTY_TERMS_KEYS = ("35",)
SUPPLIER_WARRANTY_KEYS = ("9",)
# Preferred keys of the variation document.
COLOUR_KEYS = ("94", "275", "366", "393", "468", "624", "742", "772", "795", "945", "995", "1076", "1269", "1283", "1317",
               "1347", "1362", "1450", "1492", "1532", "1717")
BASIC_COLOUR_KEYS = ("62", "210", "381", "410", "517", "587", "687", "765", "789", "815", "976", "1139", "1165", "1291",
                     "1310", "1339", "1399", "1480", "1509", "1627", "1734")
SECOND_COLOUR_KEYS = ("468", "795")
APPAREL_SIZE_KEYS = ("502", "794")

# A return picked up at home, and one brought to a counter.
HOME_PICKUP, COUNTER = "HOME_PICKUP", "MODULO"

# Who bears a balance, by the final outcome of the claim and by the state of the return.
BEARER_BY_OUTCOME = {
    "Saldo por recuperar Seller": ("Devuelto a seller", "Error de seller", "Pedido no entregado a cliente", "Seller no responde"),
    "Saldo por recuperar HD": ("Error de OPL", "OPL no responde", "Siniestro OPL"),
    "Gasto": ("Caso cerrado por mediacion", "Caso improcedente o sin evidencias", "Cliente no responde", "Error sistemico",
              "Pedido entregado al cliente", "Reembolso fuera de plazo"),
}
BEARER_BY_RETURN = ("Saldo por recuperar Seller", ("Entregado", "Custodia", "En Devolucion", "Siniestro"))
