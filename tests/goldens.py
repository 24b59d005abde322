"""Published result rows, typed in as fixtures."""

# Item, type, tag, price, margin, units over 128 business days, mean, spread and peak mean per day,
# total profit, cumulative share, class.
PROFILE = [
    ('M03', '主食', 'Red_Meat', '880', '0.35', 528, 4.125, 2.626335430838108, 6.357142857142857, 162624.0, 0.06, 'A'),
    ('W07', '酒水', 'Red_Meat', '380', '0.75', 547, 4.2734375, 2.866353396100798, 6.357142857142857, 155895.0, 0.118, 'A'),
    ('S03', '副食', 'Cheese', '380', '0.65', 626, 4.890625, 3.2921629082068873, 6.976190476190476, 154622.0, 0.175, 'A'),
    ('S04', '副食', 'Cheese', '340', '0.66', 596, 4.65625, 2.7102532060574864, 6.785714285714286, 133742.0, 0.224, 'A'),
    ('W06', '酒水', 'Cheese', '350', '0.76', 483, 3.7734375, 2.5104971548613486, 5.404761904761905, 128478.0, 0.272, 'A'),
    ('S01', '副食', 'Seafood', '280', '0.7', 641, 5.0078125, 3.2055466047825703, 7.5, 125636.0, 0.318, 'A'),
    ('W04', '酒水', 'Seafood', '280', '0.61', 711, 5.5546875, 3.722264558690299, 8.285714285714286, 121439.0, 0.363, 'A'),
    ('W03', '酒水', 'Seafood', '260', '0.62', 752, 5.875, 3.7730916331890145, 8.642857142857142, 121222.0, 0.407, 'A'),
    ('W02', '酒水', 'Red_Meat', '320', '0.6', 590, 4.609375, 3.1227747983075695, 7.285714285714286, 113280.0, 0.449, 'A'),
    ('M02', '主食', 'Red_Meat', '520', '0.38', 525, 4.1015625, 2.7574947084136237, 6.476190476190476, 103740.0, 0.488, 'A'),
    ('S02', '副食', 'Seafood', '260', '0.68', 582, 4.546875, 2.7916054562960806, 6.761904761904762, 102898.0, 0.526, 'A'),
    ('W11', '酒水', 'Cheese', '300', '0.74', 461, 3.6015625, 2.657154489357922, 5.357142857142857, 102342.0, 0.563, 'A'),
    ('W12', '酒水', 'Universal', '340', '0.77', 389, 3.0390625, 2.2357240675671965, 4.619047619047619, 101840.0, 0.601, 'A'),
    ('M06', '主食', 'Seafood', '460', '0.42', 525, 4.1015625, 2.370553753540552, 5.4523809523809526, 101430.0, 0.638, 'A'),
    ('M01', '主食', 'Red_Meat', '480', '0.4', 519, 4.0546875, 2.5512343584956088, 5.928571428571429, 99648.0, 0.675, 'A'),
    ('W01', '酒水', 'Red_Meat', '280', '0.62', 571, 4.4609375, 2.869613663673241, 6.9523809523809526, 99126.0, 0.712, 'B'),
    ('M04', '主食', 'Cheese', '420', '0.45', 503, 3.9296875, 2.7036970714802178, 6.428571428571429, 95067.0, 0.747, 'B'),
    ('S06', '副食', 'Fried', '220', '0.7', 575, 4.4921875, 2.82841625017464, 6.380952380952381, 88550.0, 0.78, 'B'),
    ('M05', '主食', 'Seafood', '380', '0.44', 508, 3.96875, 2.5252660263696995, 5.690476190476191, 84938.0, 0.811, 'B'),
    ('W08', '酒水', 'Universal', '300', '0.78', 358, 2.796875, 1.977668136933626, 4.119047619047619, 83772.0, 0.842, 'B'),
    ('S05', '副食', 'Fried', '180', '0.72', 620, 4.84375, 3.1408848244268612, 7.785714285714286, 80352.0, 0.872, 'B'),
    ('W05', '酒水', 'Fried', '300', '0.63', 372, 2.90625, 2.3725380940827936, 4.619047619047619, 70308.0, 0.898, 'B'),
    ('S07', '副食', 'Universal', '160', '0.68', 635, 4.9609375, 3.123198299517698, 7.714285714285714, 69088.0, 0.923, 'C'),
    ('W09', '酒水', 'Fried', '260', '0.58', 348, 2.71875, 2.03874865125452, 4.357142857142857, 52478.0, 0.942, 'C'),
    ('W13', '酒水', 'Universal', '180', '0.8', 349, 2.7265625, 1.9751002914832763, 4.166666666666667, 50256.0, 0.961, 'C'),
    ('W10', '酒水', 'Fried', '240', '0.57', 347, 2.7109375, 2.0472849074142037, 3.9285714285714284, 47470.0, 0.979, 'C'),
    ('D01', '甜點', 'Dessert', '180', '0.65', 253, 1.9765625, 1.518727418742726, 2.9523809523809526, 29601.0, 0.989, 'C'),
    ('D02', '甜點', 'Dessert', '160', '0.67', 267, 2.0859375, 1.4689829560607062, 3.0, 28622.0, 1.0, 'C'),
]

# Item, on hand, safety stock, reorder point, days of cover, suggested quantity, status, surplus, its cost.
ADVICE = [
    ('M03', 7.0, 7.6, 20.3, 1.1, 14, 'urgent', 0.0, 0.0),
    ('M02', 5.0, 8.0, 20.9, 0.8, 16, 'urgent', 0.0, 0.0),
    ('S02', 5.0, 5.7, 12.5, 0.7, 8, 'urgent', 0.0, 0.0),
    ('M01', 5.0, 7.4, 19.3, 0.8, 15, 'urgent', 0.0, 0.0),
    ('M04', 18.0, 7.7, 27.0, 2.8, 10, 'urgent', 0.0, 0.0),
    ('S06', 14.0, 8.1, 27.2, 2.2, 14, 'urgent', 0.0, 0.0),
    ('S03', 27.0, 11.7, 32.6, 3.9, 6, 'low', 0.0, 0.0),
    ('S04', 24.0, 9.6, 30.0, 3.5, 6, 'low', 0.0, 0.0),
    ('S01', 10.0, 6.6, 14.1, 1.3, 5, 'low', 0.0, 0.0),
    ('M06', 7.0, 4.9, 10.3, 1.3, 4, 'low', 0.0, 0.0),
    ('M05', 7.0, 4.2, 9.9, 1.2, 3, 'low', 0.0, 0.0),
    ('S05', 26.0, 9.0, 32.3, 3.3, 7, 'low', 0.0, 0.0),
    ('W07', 76.0, 13.1, 44.9, 12.0, 0, 'enough', 0.0, 0.0),
    ('W06', 50.0, 11.5, 38.5, 9.3, 0, 'enough', 0.0, 0.0),
    ('W04', 122.0, 17.1, 58.5, 14.7, 0, 'enough', 0.0, 0.0),
    ('W03', 131.0, 17.3, 60.5, 15.2, 0, 'enough', 0.0, 0.0),
    ('W02', 63.0, 14.3, 50.7, 8.6, 0, 'enough', 0.0, 0.0),
    ('W11', 87.0, 12.2, 39.0, 16.2, 0, 'enough', 0.0, 0.0),
    ('W12', 62.0, 10.2, 33.3, 13.4, 0, 'enough', 0.0, 0.0),
    ('W01', 67.0, 10.6, 45.3, 9.6, 0, 'enough', 0.0, 0.0),
    ('W08', 57.0, 7.3, 27.9, 13.8, 0, 'enough', 0.0, 0.0),
    ('W05', 48.0, 8.8, 31.8, 10.4, 0, 'enough', 0.0, 0.0),
    ('S07', 59.0, 5.7, 21.1, 7.6, 0, 'enough', 5.0, 256.0),
    ('W09', 117.0, 5.8, 27.6, 26.9, 0, 'enough', 0.0, 0.0),
    ('W13', 111.0, 5.7, 26.5, 26.6, 0, 'enough', 0.0, 0.0),
    ('W10', 78.0, 5.9, 25.5, 19.9, 0, 'enough', 0.0, 0.0),
    ('D01', 7.0, 1.9, 4.9, 2.4, 0, 'enough', 0.0, 0.0),
    ('D02', 5.0, 1.9, 4.9, 1.7, 0, 'enough', 0.0, 0.0),
]

# Sku, category, unit, opening, received, sold, theoretical, counted, raw variance, old ratio, cost, price.
INVENTORY = [
    ('生啤酒(杯)', '酒水', '杯', 97, 681, 649, 129, 126, 3, 0.0232558139534884, '60', '180'),
    ('紅酒(杯)', '酒水', '杯', 60, 418, 398, 80, 77, 3, 0.0375, '80', '220'),
    ('白酒(杯)', '酒水', '杯', 46, 326, 310, 62, 57, 5, 0.0806451612903226, '80', '220'),
    ('經典調酒', '酒水', '杯', 39, 276, 263, 52, 51, 1, 0.0192307692307692, '90', '280'),
    ('特調調酒', '酒水', '杯', 29, 168, 191, 6, 8, -2, -0.333333333333333, '110', '320'),
    ('松露薯條', '前菜', '份', 71, 497, 473, 95, 95, 0, 0.0, '70', '220'),
    ('炸魷魚圈', '前菜', '份', 53, 374, 356, 71, 67, 4, 0.0563380281690141, '85', '240'),
    ('烤時蔬', '前菜', '份', 45, 318, 303, 60, 57, 3, 0.05, '55', '180'),
    ('主廚牛排', '主餐', '份', 33, 194, 220, 7, 3, 4, 0.571428571428571, '220', '580'),
    ('海鮮燉飯', '主餐', '份', 36, 255, 243, 48, 44, 4, 0.0833333333333333, '150', '420'),
    ('手工披薩', '主餐', '份', 46, 324, 309, 61, 61, 0, 0.0, '130', '380'),
    ('提拉米蘇', '甜點', '份', 37, 260, 248, 49, 43, 6, 0.122448979591837, '50', '160'),
]

# Sku, variance ratio, waste cost, days of cover, cover state.
STOCKTAKE = [
    ('生啤酒(杯)', 0.004622496147919877, 180.0, 6.02, '🟢 充足'),
    ('紅酒(杯)', 0.007537688442211055, 240.0, 6.0, '🟢 充足'),
    ('白酒(杯)', 0.016129032258064516, 400.0, 5.7, '🟢 充足'),
    ('經典調酒', 0.0038022813688212928, 90.0, 6.01, '🟢 充足'),
    ('特調調酒', -0.010471204188481676, -220.0, 1.3, '🟡 不足 3 日'),
    ('松露薯條', 0.0, 0.0, 6.23, '🟢 充足'),
    ('炸魷魚圈', 0.011235955056179775, 340.0, 5.83, '🟢 充足'),
    ('烤時蔬', 0.009900990099009901, 165.0, 5.83, '🟢 充足'),
    ('主廚牛排', 0.01818181818181818, 880.0, 0.42, '🔴 不足 1 日'),
    ('海鮮燉飯', 0.01646090534979424, 600.0, 5.61, '🟢 充足'),
    ('手工披薩', 0.0, 0.0, 6.12, '🟢 充足'),
    ('提拉米蘇', 0.024193548387096774, 300.0, 5.38, '🟢 充足'),
]

# Sku, margin rate, total margin, cost share, margin share, flagged.
MARGIN = [
    ('主廚牛排', 0.6206896551724138, 79200.0, 0.13530324420278714, 0.11639783958555315, True),
    ('生啤酒(杯)', 0.6666666666666666, 77880.0, 0.108857610108606, 0.1144578755924606, False),
    ('手工披薩', 0.6578947368421053, 77250.0, 0.11229610164516445, 0.11353198368666642, False),
    ('松露薯條', 0.6818181818181818, 70950.0, 0.09255971932963393, 0.1042730646287247, False),
    ('海鮮燉飯', 0.6428571428571429, 65610.0, 0.10189676138825601, 0.09642502847485028, True),
    ('紅酒(杯)', 0.6363636363636364, 55720.0, 0.08900940693009798, 0.0818899952235735, True),
    ('炸魷魚圈', 0.6458333333333334, 55180.0, 0.08459248284248634, 0.08109637359003564, True),
    ('經典調酒', 0.6785714285714286, 49970.0, 0.06616999566694155, 0.07343939449608701, False),
    ('白酒(杯)', 0.6363636363636364, 43400.0, 0.06932893504605622, 0.06378366462137634, True),
    ('特調調酒', 0.65625, 40110.0, 0.058733908278937146, 0.058948451335562334, False),
    ('烤時蔬', 0.6944444444444444, 37875.0, 0.04658736703800512, 0.05566373957453062, False),
    ('提拉米蘇', 0.6875, 27280.0, 0.03466446752302811, 0.04009258919057942, False),
]

# Sku, class, level, lead time, median and high forecast, safety stock, reorder point, target, raw quantity,
# order, exception, reason.
ORDERS = [
    ('生啤酒(杯)', 'A', 0.98, 5, 101.5, 115.3, 55.1, 156.6, 177.5, 51.5, 60, False, ''),
    ('特調調酒', 'B', 0.95, 5, 31.0, 40.7, 14.5, 45.5, 51.7, 43.7, 48, False, ''),
    ('紅酒(杯)', 'A', 0.98, 5, 63.0, 78.0, 34.9, 97.9, 110.7, 33.7, 36, False, ''),
    ('白酒(杯)', 'A', 0.98, 5, 52.0, 63.2, 26.6, 78.6, 88.6, 31.6, 36, False, ''),
    ('經典調酒', 'B', 0.95, 5, 42.0, 52.7, 18.8, 60.8, 69.3, 18.3, 24, False, ''),
    ('主廚牛排', 'A', 0.98, 2, 16.0, 19.7, 10.3, 26.3, 33.4, 30.4, 18, True, '受保存期 3 天限制,由 35 降為 18(超額部分將成廚餘)'),
    ('手工披薩', 'A', 0.98, 2, 19.5, 24.4, 14.4, 33.9, 43.9, 0.0, 0, False, ''),
    ('海鮮燉飯', 'A', 0.98, 2, 17.5, 22.4, 11.7, 29.2, 37.0, 0.0, 0, False, ''),
    ('松露薯條', 'A', 0.98, 2, 32.0, 36.4, 18.1, 50.1, 65.4, 0.0, 0, False, ''),
    ('炸魷魚圈', 'A', 0.98, 2, 26.0, 29.8, 14.0, 40.0, 51.5, 0.0, 0, False, ''),
    ('烤時蔬', 'C', 0.9, 2, 18.5, 23.4, 8.0, 26.5, 36.3, 0.0, 0, False, ''),
    ('提拉米蘇', 'C', 0.9, 1, 8.0, 11.7, 4.3, 12.3, 20.3, 0.0, 0, False, ''),
]

# Segment, customers, visits, spend, drink ratio, stay, hour, profit, name, value multiple.
SEGMENTS = [
    (0, 236, 2.28, 1000.03, 0.44, 105.33, 20.89, '886557.4', '夜間酒客', 0.97),
    (1, 221, 2.38, 875.85, 0.26, 82.55, 19.6, '686179.4', '餐點取向客', 0.8),
    (2, 60, 4.53, 986.28, 0.4, 99.5, 20.52, '425082.8', '核心常客', 1.83),
]

# The rules of one fish dish: drink id, name, tag, support, confidence, lift, unit profit, expected profit.
FISH_RULES = [
    ('W04', '白蘇維翁(杯)', 'Seafood', 0.1021, 0.3936, 1.377, '170.8', '67.2'),
    ('W07', 'Old Fashioned', 'Red_Meat', 0.0607, 0.234, 0.955, '285.0', '66.7'),
    ('W03', '夏多內白酒(杯)', 'Seafood', 0.1054, 0.4064, 1.341, '161.2', '65.5'),
    ('W06', 'Negroni', 'Cheese', 0.0579, 0.2234, 0.987, '266.0', '59.4'),
    ('W12', '季節水果特調', 'Universal', 0.0513, 0.1979, 1.051, '261.8', '51.8'),
    ('W02', '卡本內蘇維翁(杯)', 'Red_Meat', 0.0596, 0.2298, 0.903, '192.0', '44.1'),
    ('W08', 'Gin & Tonic', 'Universal', 0.0469, 0.1809, 1.057, '234.0', '42.3'),
    ('W11', '威士忌 Highball', 'Cheese', 0.0469, 0.1809, 0.879, '222.0', '40.1'),
    ('W05', '氣泡酒(杯)', 'Fried', 0.0502, 0.1936, 1.093, '189.0', '36.6'),
    ('W01', '馬爾貝克紅酒(杯)', 'Red_Meat', 0.0486, 0.1872, 0.759, '173.6', '32.5'),
    ('W10', '小麥白啤酒', 'Fried', 0.0508, 0.1957, 1.144, '136.8', '26.8'),
    ('W13', '無酒精莫吉托', 'Universal', 0.0469, 0.1809, 1.061, '144.0', '26.0'),
    ('W09', '精釀 IPA', 'Fried', 0.043, 0.166, 0.973, '150.8', '25.0'),
]
