"""The four CSV inputs bundled with the reference jobs, as literals (file order kept:
order matters for the arrival-order operators). Comma separated, no header."""

# Rows of the bundled input file, as they stand.
LOGIN_LOG = """\
5402,83.149.11.115,success,1558430815
23064,66.249.3.15,fail,1558430826
5692,80.149.25.29,fail,1558430833
7233,86.226.15.75,success,1558430832
5692,80.149.25.29,success,1558430840
29607,66.249.73.135,success,1558430841
1035,83.149.9.216,fail,1558430842
1035,83.149.9.216,success,1558430844
1035,83.149.9.216,fail,1558430843
7328,193.114.45.13,success,1558430848
29607,66.249.73.135,success,1558430847
2133,50.16.19.13,success,1558430857
6745,66.249.73.185,success,1558430859
76456,110.136.166.128,success,1558430853
8345,46.105.14.53,success,1558430855
76456,110.136.166.128,success,1558430857
76456,110.136.166.128,success,1558430854
76456,110.136.166.128,fail,1558430859
76456,110.136.166.128,success,1558430861
3464,123.125.71.35,success,1558430860
76456,110.136.166.128,success,1558430865
65322,50.150.204.184,success,1558430866
23565,207.241.237.225,fail,1558430862
8455,200.49.190.101,success,1558430867
8455,200.49.190.100,success,1558430865
8455,200.49.190.101,success,1558430869
8455,200.49.190.101,success,1558430872
32031,66.249.73.185,success,1558430875
12018,66.249.73.135,success,1558430874
12018,66.249.73.135,success,1558430879
12018,66.249.73.135,success,1558430881
21419,67.214.178.190,success,1558430882
21419,67.214.178.190,success,1558430880
23565,207.241.237.220,success,1558430881
2386,46.105.14.53,success,1558430883
23565,207.241.237.227,success,1558430884
83419,91.177.205.119,success,1558430881
83419,91.177.205.119,fail,1558430882
83419,91.177.205.119,success,1558430885
83419,91.177.205.119,fail,1558430886
83419,91.177.205.119,success,1558430884
83419,91.177.205.119,success,1558430886
4325,26.249.73.15,success,1558430888
2123,207.241.237.228,success,1558430887
21083,207.241.237.101,success,1558430889
13490,87.169.99.232,success,1558430886
93765,209.85.238.199,success,1558430890
93765,209.85.238.199,success,1558430892
"""

# Rows of the bundled input file, as they stand.
ORDER_LOG = """\
34729,create,,1558430842
34730,create,,1558430843
34729,pay,sd76f87d6,1558430844
34730,modify,3hu3k2432,1558430845
34731,create,,1558430846
34731,pay,35jue34we,1558430849
34732,create,,1558430852
34733,create,,1558430855
34734,create,,1558430859
34732,pay,32h3h4b4t,1558430861
34735,create,,1558430862
34734,pay,435kjb45d,1558430863
34733,pay,766lk5nk4,1558430864
34736,create,,1558430866
34737,create,,1558430868
34735,pay,5k432k4n,1558430869
34738,create,,1558430871
34739,create,,1558430874
34736,pay,435kjb45s,1558430875
34740,create,,1558430877
34741,create,,1558430882
34742,create,,1558430884
34743,create,,1558430885
34744,create,,1558430886
34745,create,,1558430889
34746,create,,1558430892
34747,create,,1558430893
34748,create,,1558430895
34746,pay,3243hr9h9,1558430895
34738,pay,43jhin3k4,1558430896
34745,pay,8xz09ddsaf,1558430896
34741,pay,88df0wn92,1558430896
34749,create,,1558430899
34747,pay,329d09f9f,1558430893
34743,pay,3hefw8jf,1558430900
34750,create,,1558430901
34737,pay,324jnd45s,1558430902
34751,create,,1558430902
34744,pay,499dfano2,1558430903
34752,create,,1558430905
34742,pay,435kjb4432,1558430906
34753,create,,1558430906
34739,pay,98x0f8asd,1558430907
34754,create,,1558430908
34755,create,,1558430911
34740,pay,392094j32,1558430913
34756,create,,1558430913
34753,pay,8c6vs8dd,1558430913
34757,create,,1558430915
34749,pay,324n0239,1558430916
34755,pay,8x0zvy8w3,1558430918
34758,create,,1558430921
34759,create,,1558430922
34752,pay,rnp435rk,1558430925
34760,create,,1558430926
34761,create,,1558430927
34762,create,,1558430933
34748,pay,809saf0ff,1558430934
34763,create,,1558430936
34764,create,,1558430938
34765,create,,1558430940
34751,pay,24309dsf,1558430941
34750,pay,sad90df3,1558430941
34761,pay,902dsqw45,1558430943
34766,create,,1558430944
34767,create,,1558430949
34768,pay,88snrn932,1558430950
34759,pay,9203kmfn,1558430950
34754,pay,3245nbo7,1558430950
34758,pay,32499fd9w,1558430950
34760,pay,390mf2398,1558430960
34757,pay,d8938034,1558430962
34762,pay,84309dw31r,1558430983
34763,pay,sddf9809ew,1558431068
34764,pay,832jksmd9,1558431079
34765,pay,m23sare32e,1558431082
34766,pay,92nr903msa,1558431095
34756,pay,9032n4fd2,1558431951
34767,pay,sdafen9932,1558432021
"""

# Rows of the bundled input file, as they stand.
RECEIPT_LOG = """\
ewr342as4,wechat,1558430845
sd76f87d6,wechat,1558430847
3hu3k2432,alipay,1558430848
8fdsfae83,alipay,1558430850
32h3h4b4t,wechat,1558430852
766lk5nk4,wechat,1558430855
435kjb45d,alipay,1558430859
5k432k4n,wechat,1558430862
435kjb45s,wechat,1558430866
324jnd45s,wechat,1558430868
43jhin3k4,wechat,1558430871
98x0f8asd,alipay,1558430874
392094j32,wechat,1558430877
88df0wn92,alipay,1558430882
435kjb4432,alipay,1558430884
3hefw8jf,alipay,1558430885
499dfano2,wechat,1558430886
8xz09ddsaf,wechat,1558430889
3243hr9h9,wechat,1558430892
329d09f9f,alipay,1558430893
809saf0ff,wechat,1558430895
324n0239,wechat,1558430899
sad90df3,alipay,1558430901
24309dsf,alipay,1558430902
rnp435rk,wechat,1558430905
8c6vs8dd,wechat,1558430906
3245nbo7,alipay,1558430908
8x0zvy8w3,alipay,1558430911
9032n4fd2,wechat,1558430913
d8938034,wechat,1558430915
32499fd9w,alipay,1558430921
9203kmfn,alipay,1558430922
390mf2398,alipay,1558430926
902dsqw45,wechat,1558430927
84309dw31r,alipay,1558430933
sddf9809ew,alipay,1558430936
832jksmd9,wechat,1558430938
m23sare32e,wechat,1558430940
92nr903msa,wechat,1558430944
sdafen9932,alipay,1558430949
"""

# Rows of the bundled input file, as they stand.
AD_CLICK_LOG = """\
543462,1715,beijing,beijing,1511658000
662867,2244074,guangdong,guangzhou,1511658060
561558,3611281,guangdong,shenzhen,1511658120
894923,1715,beijing,beijing,1511658180
834377,2244074,shanghai,shanghai,1511658240
625915,3611281,guangdong,zhuhai,1511658300
578814,1715,guangdong,shenzhen,1511658330
873335,1256540,shanghai,shanghai,1511658540
429984,2244074,guangdong,shenzhen,1511658600
937166,1715,beijing,beijing,1511661601
937166,1715,beijing,beijing,1511661602
937166,1715,beijing,beijing,1511661603
937166,1715,beijing,beijing,1511661604
937166,1715,beijing,beijing,1511661605
937166,1715,beijing,beijing,1511661606
937166,1715,beijing,beijing,1511661607
937166,1715,beijing,beijing,1511661608
161501,36156,jiangsu,nanjing,1511661608
937166,1715,beijing,beijing,1511661609
937166,1715,beijing,beijing,1511661610
937166,1715,beijing,beijing,1511661611
937166,1715,beijing,beijing,1511661612
937166,1715,beijing,beijing,1511661613
937166,1715,beijing,beijing,1511661614
937166,1715,beijing,beijing,1511661615
937166,1715,beijing,beijing,1511661616
937166,1715,beijing,beijing,1511661617
937166,1715,beijing,beijing,1511661618
2315,36156,zhejiang,hangzhou,1511661618
10236,5614,henan,zhengzhou,1511661619
937166,1715,beijing,beijing,1511661619
937166,1715,beijing,beijing,1511661620
937166,1715,beijing,beijing,1511661621
937166,1715,beijing,beijing,1511661622
937166,1715,beijing,beijing,1511661623
937166,1715,beijing,beijing,1511661624
937166,1715,beijing,beijing,1511661625
937166,1715,beijing,beijing,1511661626
937166,1715,beijing,beijing,1511661627
937166,1715,beijing,beijing,1511661628
937166,1715,beijing,beijing,1511661629
937166,1715,beijing,beijing,1511661630
937166,1715,beijing,beijing,1511661631
937166,1715,beijing,beijing,1511661632
937166,1715,beijing,beijing,1511661633
937166,1715,beijing,beijing,1511661634
937166,1715,beijing,beijing,1511661635
937166,1715,beijing,beijing,1511661636
937166,1715,beijing,beijing,1511661637
937166,1715,beijing,beijing,1511661638
937166,1715,beijing,beijing,1511661639
937166,1715,beijing,beijing,1511661640
2315,36237,zhejiang,hangzhou,1511661641
10236,2914,henan,zhengzhou,15116616641
2315,7156,zhejiang,hangzhou,1511661641
10236,5389,hebei,shijiazhuang,1511661641
937166,1715,beijing,beijing,1511661641
937166,1715,beijing,beijing,1511661642
937166,1715,beijing,beijing,1511661643
937166,1715,beijing,beijing,1511661644
937166,1715,beijing,beijing,1511661645
937166,1715,beijing,beijing,1511661646
937166,1715,beijing,beijing,1511661647
937166,1715,beijing,beijing,1511661648
937166,1715,beijing,beijing,1511661649
937166,1715,beijing,beijing,1511661650
937166,1715,beijing,beijing,1511661651
937166,1715,beijing,beijing,1511661652
161501,36156,jiangsu,nanjing,1511661652
937166,1715,beijing,beijing,1511661653
937166,1715,beijing,beijing,1511661654
161501,36156,jiangsu,nanjing,1511661654
161501,36156,jiangsu,nanjing,1511661655
937166,1715,beijing,beijing,1511661655
937166,1715,beijing,beijing,1511661656
937166,1715,beijing,beijing,1511661657
937166,1715,beijing,beijing,1511661658
937166,1715,beijing,beijing,1511661659
937166,1715,beijing,beijing,1511661660
937166,1715,beijing,beijing,1511661661
937166,1715,beijing,beijing,1511661662
937166,1715,beijing,beijing,1511661663
937166,1715,beijing,beijing,1511661664
937166,1715,beijing,beijing,1511661665
937166,1715,beijing,beijing,1511661666
937166,1715,beijing,beijing,1511661667
937166,1715,beijing,beijing,1511661668
937166,1715,beijing,beijing,1511661669
937166,1715,beijing,beijing,1511661670
937166,1715,beijing,beijing,1511661671
937166,1715,beijing,beijing,1511661672
937166,1715,beijing,beijing,1511661673
937166,1715,beijing,beijing,1511661674
937166,1715,beijing,beijing,1511661675
937166,1715,beijing,beijing,1511661676
937166,1715,beijing,beijing,1511661677
937166,1715,beijing,beijing,1511661678
937166,1715,beijing,beijing,1511661679
937166,1715,beijing,beijing,1511661680
937166,1715,beijing,beijing,1511661681
937166,1715,beijing,beijing,1511661682
937166,1715,beijing,beijing,1511661683
937166,1715,beijing,beijing,1511661684
937166,1715,beijing,beijing,1511661685
937166,1715,beijing,beijing,1511661686
937166,1715,beijing,beijing,1511661687
937166,1715,beijing,beijing,1511661688
937166,1715,beijing,beijing,1511661689
937166,1715,beijing,beijing,1511661690
937166,1715,beijing,beijing,1511661691
937166,1715,beijing,beijing,1511661692
2315,36237,zhejiang,hangzhou,1511661692
10236,2914,henan,zhengzhou,15116616693
2315,7156,zhejiang,hangzhou,1511661693
937166,1715,beijing,beijing,1511661693
937166,1715,beijing,beijing,1511661694
937166,1715,beijing,beijing,1511661695
937166,1715,beijing,beijing,1511661696
937166,1715,beijing,beijing,1511661697
937166,1715,beijing,beijing,1511661698
937166,1715,beijing,beijing,1511661699
937166,1715,beijing,beijing,1511661700
937166,1715,beijing,beijing,1511661701
937166,1715,beijing,beijing,1511661702
937166,1715,beijing,beijing,1511661703
937166,1715,beijing,beijing,1511661704
937166,1715,beijing,beijing,1511661705
937166,1715,beijing,beijing,1511661706
937166,1715,beijing,beijing,1511661707
937166,1715,beijing,beijing,1511661708
937166,1715,beijing,beijing,1511661709
937166,1715,beijing,beijing,1511661710
937166,1715,beijing,beijing,1511661711
937166,1715,beijing,beijing,1511661712
937166,1715,beijing,beijing,1511661713
937166,1715,beijing,beijing,1511661714
937166,1715,beijing,beijing,1511661715
937166,1715,beijing,beijing,1511661716
937166,1715,beijing,beijing,1511661717
937166,1715,beijing,beijing,1511661718
937166,1715,beijing,beijing,1511661719
937166,1715,beijing,beijing,1511661710
937166,1715,beijing,beijing,1511661711
"""
