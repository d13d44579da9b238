"""Place names, titles, dialling codes and default texts."""

from __future__ import annotations

COUNTRY_NAMES = {
    "中国": "China",
    "España": "Spain",
    "Deutschland": "Germany",
}

# Order matters once: 苏州 comes before 苏州（江苏省）.
CITY_NAMES = {
    "München": "munich", "Köln": "cologne", "Frankfurt am Main": "frankfurt",
    "Lisboa": "lisbon", "Guimarães": "guimaraes", "万州": "Wanzhou",
    "上海": "Shanghai", "东莞": "Dongguan", "中山": "Zhongshan",
    "丰台": "Fengtai", "乐山": "Leshan", "佛山": "Foshan", "保定": "Baoding",
    "北京": "Beijing", "南山": "Nanshan", "南开": "Nankai", "南通": "Nantong",
    "双流": "Shuangliu", "合川": "Hechuan", "吴中": "Wuzhong",
    "和平": "Heping", "咸宁": "Xianning", "咸阳": "Xianyang",
    "唐山": "Tangshan", "嘉兴": "Jiaxing", "嘉定": "Jiading", "大足": "Dazu",
    "天河": "Tianhe", "天津": "Tianjin", "太仓": "Taicang", "姑苏": "Gusu",
    "宝安": "Bao'an", "宝山": "Baoshan", "宝鸡": "Baoji", "常熟": "Changshu",
    "广州": "Guangzhou", "廊坊": "Langfang", "张家口": "Zhangjiakou",
    "张家港": "Zhangjiagang", "德阳": "Deyang", "惠州": "Huizhou",
    "成都": "Chengdu", "承德": "Chengde", "新城": "Xincheng",
    "新洲": "Xinzhou", "无锡": "Wuxi", "昆山": "Kunshan", "朝阳": "Chaoyang",
    "杭州": "Hangzhou", "武侯": "Wuhou", "武昌": "Wuchang", "武汉": "Wuhan",
    "汉中": "Hanzhong", "汉阳": "Hanyang", "江北": "Jiangbei",
    "江岸": "Jiang'an", "江汉": "Jianghan", "沙坪坝": "Shapingba",
    "沧州": "Cangzhou", "河东": "Hedong", "河西": "Hexi", "浦东": "Pudong",
    "海淀": "Haidian", "涪陵": "Fuling", "深圳": "Shenzhen",
    "清远": "Qingyuan", "渝中": "Yuzhong", "渝北": "Yubei", "渭南": "Weinan",
    "滨海": "Binhai", "澳门": "Macau", "珠海": "Zhuhai", "璧山": "Bishan",
    "白云": "Baiyun", "相城": "Xiangcheng", "眉山": "Meishan",
    "石家庄": "Shijiazhuang", "硚口": "Qiaokou", "碑林": "Beilin",
    "福田": "Futian", "秦皇岛": "Qinhuangdao", "绵阳": "Mianyang",
    "苏州": "Suzhou", "苏州（江苏省）": "Suzhou (Jiangsu)", "莲湖": "Lianhu",
    "虎丘": "Huqiu", "虹口": "Hongkou", "西安": "Xi'an", "资阳": "Ziyang",
    "越秀": "Yuexiu", "通州": "Tongzhou", "鄂州": "Ezhou",
    "重庆": "Chongqing", "铜川": "Tongchuan", "锦江": "Jinjiang",
    "长安": "Chang'an", "闵行": "Minhang", "雁塔": "Yanta",
    "青羊": "Qingyang", "香港": "Hong Kong", "黄冈": "Huanggang",
    "黄陂": "Huangpi", "黔江": "Qianjiang", "龙岗": "Longgang",
    "龙泉驿": "Longquanyi",
}

# Titles and degrees removed from names, in match order.
NAME_TITLES = (
    "B.Sc.", "B.A.", "Univ.Prof.", "B.Eng.", "MBA.", "Dipl.-Ing.", "Ing.",
    "Prof.", "MD", "DDS", "Dr.", "Mrs.", "DVM",
)

DIAL_CODES = {
    "United Kingdom": "44",
    "China": "86",
    "France": "33",
    "Germany": "49",
    "Spain": "34",
    "United States": "1",
    "Portugal": "351",
}

# Defaults and replacements of the cleaning jobs.
NO_VALUE = "Not Specified"
NO_SIZE = "One Size"
EVERY_CATEGORY = "All"
CHILDREN_RANGE_OLD = "Girl and Boy (1-5 years, 6-14 years)"
CHILDREN_RANGE_NEW = "Children(1-14 years)"

# Stores whose staff names are written in Chinese, and the matching country.
CHINESE_STORES = (6, 7, 8, 9, 10)
CHINESE_COUNTRY = "China"

STORE_WIDE_DISCOUNTS = (0.5, 0.6)
