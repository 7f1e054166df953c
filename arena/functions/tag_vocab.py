"""Effect tag vocabulary. Fixed values: (tag, patterns, scope); scope None applies everywhere."""

from __future__ import annotations

EFFECT_TAGS: list[tuple[str, list[str], str | None]] = [
    ("draw", [r"抽(?:取)?\d*张", r"抽(?:到|直至|直到)", "抽卡", r"直到自己的?手牌(?:数量)?变为\d+张", "抽取与.{0,24}相同数量的卡牌"], None),
    ("search", ["选择.{0,8}牌库", "牌库中.{0,6}选择", "从自己?牌库(?!上方|下方)", "将自己牌库中", "寻找", "查看自己?牌库", r"牌库下方?\d+张"], None),
    ("mill", ["自己?牌库.{0,10}放于弃牌区", r"牌库上方?\d+张卡牌?，?(全部)?放于弃牌区", "对手牌库.{0,30}放于弃牌区"], None),
    ("discard_recover", ["弃牌区.{0,30}(加入手牌|放回|返回|回手牌|放于备战区|放于场上)", r"弃牌区中的.{0,24}合计最多\d+张.{0,14}加入手牌"], None),
    ("hand_disrupt", ["手牌.{0,10}(丢|弃|放回|重洗|公开|查看)", "对手.{0,4}手牌"], None),
    ("damage_boost", [r"伤害[「\"']?\+", "伤害增加", "造成的?伤害.{0,4}[+增]", r"追加造成\d+点?伤害", "倍增", "变为2倍"], None),
    ("spread", [r"(?<!被)放置(?:最多)?\d*个?伤害指示物", "伤害指示物.{0,12}放置于", "转放于对手", r"也造成\d+伤害", "对.{0,8}备战宝可梦.{0,6}造成"], None),
    ("heal", ["回复", "恢复"], None),
    ("protection", ["不.{0,2}会受到", "不受到", "伤害.{0,3}[-减]", "减轻", "免疫", "不会陷入", "弱点.{0,4}消除", "抵抗力", "不会【?昏厥", "被放置伤害指示物"], None),
    ("status", ["中毒", "灼伤", "烧伤", "麻痹", "睡眠", "混乱", "特殊状态"], None),
    ("energy_accel", ["能量.{0,12}附着", r"附着\d?张.{0,14}能量", "填能"], None),
    ("energy_move", ["转附", "移动.{0,4}能量", "能量.{0,4}移动"], None),
    ("energy_disrupt", ["(对手|双方).{0,14}能量.{0,6}(丢|弃|放回|移除)", "(对手|对方|那只宝可梦|使用了招式的宝可梦).{0,24}能量.{0,4}放于弃牌区", "能量.{0,4}放回对手"], None),
    ("gust", ["对手.{0,6}(备战|宝可梦).{0,6}(互换|交换)", r"选择对手的?\d?只备战宝可梦，?将其与战斗", "对手.{0,26}将其与战斗宝可梦互换", "与对手的?战斗宝可梦互换"], None),
    ("switch", ["自己.{0,4}(战斗|备战).{0,4}(互换|交换)", "自己的战斗宝可梦与备战宝可梦互换", "将这只宝可梦与战斗宝可梦互换", "处于战斗场上的这只宝可梦，?与备战宝可梦互换",
                "替换", "换入", "换出", "将这只宝可梦与备战"], None),
    ("bounce", ["放回?手牌", "返回手牌", "回到手牌", "放回?牌库", "放回自己的牌库", "放回各自的牌库", "返回牌库", "回到牌库"], None),
    ("removal", ["(对手|场上).{0,20}「?(竞技场|宝可梦道具)」?.{0,24}放于弃牌区", "将场上的竞技场放于弃牌区"], None),
    ("ko", ["令.{0,12}【?昏厥", "将受到.{0,24}放于弃牌区", "受到这个招式影响的宝可梦会【?昏厥", "将对手的?战斗宝可梦.{0,24}放于弃牌区"], None),
    ("copy", ["作为这个招式使用"], None),
    ("lock", ["无法", "不能", "特性.{0,20}(全部)?消除", "的效果，?(全部)?消除", "无效", "不受.{0,10}效果", "禁止", "不计算.{0,16}效果"], None),
    ("modifier", ["最大HP", "撤退.{0,6}(减少|增加|消除)", "所需.{0,4}能量.{0,6}(减少|增加|消除|变为)", "仅需.{0,10}能量便可使用",
                  "奖赏卡.{0,8}(增加|减少|多拿|少拿|查看|互换|翻到正面)", r"拿取\d?张奖赏卡", "备战区.{0,6}(变|增)", "备战区的宝可梦数量.{0,6}变",
                  r"最多放\d?张「宝可梦道具」", r"视作\d+个", "弱点", "抗性", "属性变为"], None),
    ("evolution", ["进化", "退化"], None),
    ("special_behavior", ["作为.{0,12}宝可梦.{0,4}放于场上", "学习器", "这张卡牌上的招式", "才能被放于场上"], None),
    ("coin_manipulate", ["视作反面", r"对手将抛掷\d?次硬币"], None),
    ("bench_attack", ["备战区也能使用"], None),
    ("win_condition", ["算作自己的胜利"], None),
    ("special_summon", ["将这张卡牌放于备战区", "奖赏卡中拿取了这张卡牌"], None),
    ("counter_shift_self", ["转放于(这只|自己)"], None),
]

EFFECT_FLAGS: list[tuple[str, list[str], str | None]] = [
    ("coin_flip", ["硬币"], None),
    ("once_per_turn", ["回合.{0,6}(1次|一次)", r"可以使用\d?次", r"可使用\d?次", r"有\d?次机会"], None),
    ("conditional", ["如果", "只有在", "只有当", "若", "时才", "状态下", "当.{0,12}时"], None),
]
