"""Golden inputs and outputs copied as literals from the published data files.

USA bloom table (150 rows), its 92-row cluster assignment, the five
representatives, and the header of a scoring input (location + 240 features).
"""

USA_BLOOM_CSV = """location,lat,long,alt,year,bloom_date,bloom_doy
2251,45.4856,-122.855499,63,2010,2010-02-27,58
1841,39.973316,-82.802826,275,2010,2010-04-04,94
8861,41.71357,-121.507545,1452,2013,2013-05-08,128
8861,41.71357,-121.507545,1452,2014,2014-05-01,121
8861,41.71357,-121.507545,1452,2015,2015-05-20,140
8861,41.71357,-121.507545,1452,2016,2016-04-28,119
8861,41.71357,-121.507545,1452,2017,2017-05-17,137
8861,41.71357,-121.507545,1452,2018,2018-05-23,143
8861,41.71357,-121.507545,1452,2019,2019-05-23,143
8937,41.709045,-121.514771,1506,2013,2013-05-22,142
8937,41.709045,-121.514771,1506,2014,2014-05-21,141
8937,41.709045,-121.514771,1506,2015,2015-05-20,140
8937,41.709045,-121.514771,1506,2016,2016-05-19,140
8937,41.709045,-121.514771,1506,2017,2017-05-24,144
8937,41.709045,-121.514771,1506,2019,2019-05-23,143
23040,53.93327,-116.5765,1255,2016,2016-04-19,110
27098,44.668655,-123.222923,98,2017,2017-05-19,139
27101,44.611359,-123.329849,213,2017,2017-05-15,135
33735,48.024921,-122.469193,59,2019,2019-04-28,118
33735,48.024921,-122.469193,59,2021,2021-04-18,108
29890,48.91993,-122.640564,10,2019,2019-05-11,131
29890,48.91993,-122.640564,10,2020,2020-05-09,130
29890,48.91993,-122.640564,10,2021,2021-04-30,120
29890,48.91993,-122.640564,10,2022,2022-04-28,118
6432,37.799515,-122.412834,46,2012,2012-03-29,89
6432,37.799515,-122.412834,46,2013,2013-03-23,82
3,35.879211,-84.172203,284,2011,2011-04-09,99
3,35.879211,-84.172203,284,2013,2013-04-10,100
3,35.879211,-84.172203,284,2014,2014-04-06,96
3,35.879211,-84.172203,284,2015,2015-04-07,97
10918,37.243382,-80.427132,651,2013,2013-04-18,108
8309,39.731804,-104.961166,1639,2014,2014-04-25,115
21670,42.330338,-71.049316,1,2015,2015-10-06,279
26673,39.032318,-94.59211,272,2017,2017-04-15,105
26673,39.032318,-94.59211,272,2018,2018-04-12,102
26736,40.667068,-73.991501,15,2017,2017-04-20,110
28716,44.935444,-123.031776,46,2018,2018-03-13,72
29913,38.909508,-77.07354,40,2018,2018-04-16,106
29913,38.909508,-77.07354,40,2019,2019-04-11,101
29913,38.909508,-77.07354,40,2020,2020-04-09,100
29916,38.908012,-77.072189,41,2018,2018-04-11,101
29916,38.908012,-77.072189,41,2019,2019-03-30,89
29916,38.908012,-77.072189,41,2020,2020-03-25,85
30294,40.733265,-74.666374,82,2018,2018-04-20,110
30297,40.733265,-74.666374,82,2018,2018-04-25,115
30334,40.733265,-74.666374,82,2018,2018-04-20,110
30300,40.73381,-74.668793,82,2018,2018-04-13,103
30336,40.733189,-74.669708,87,2018,2018-04-20,110
30335,40.733265,-74.666374,82,2018,2018-04-20,110
31254,38.891289,-77.03009,3,2019,2019-04-23,113
31254,38.891289,-77.03009,3,2020,2020-04-04,95
32789,40.73082,-73.99733,5,2019,2019-04-16,106
32789,40.73082,-73.99733,5,2020,2020-04-16,107
32789,40.73082,-73.99733,5,2021,2021-04-14,104
32789,40.73082,-73.99733,5,2022,2022-04-15,105
32789,40.73082,-73.99733,5,2023,2023-04-11,101
36695,37.997528,-84.401024,311,2020,2020-03-26,86
37094,39.065319,-77.117416,103,2020,2020-03-20,80
37671,40.585594,-75.569016,124,2020,2020-03-27,87
37739,40.992794,-73.662766,10,2020,2020-04-17,108
38179,39.891624,-75.028877,19,2020,2020-04-03,94
38113,37.396343,-79.28231,239,2020,2020-04-16,107
40293,38.028393,-84.499519,304,2020,2020-08-30,243
43221,40.879101,-73.147514,45,2021,2021-04-07,97
43839,44.571491,-123.282806,76,2021,2021-04-08,98
43946,47.653053,-122.30777,32,2021,2021-04-09,99
43967,44.576656,-123.282387,73,2021,2021-04-09,99
43970,45.327137,-122.917313,205,2021,2021-04-09,99
43975,47.84,-122.321098,136,2021,2021-04-10,100
43989,47.663101,-122.315498,64,2021,2021-04-11,101
43756,34.689434,135.269272,6,2021,2021-04-13,103
44023,47.381573,-122.233505,11,2021,2021-04-25,115
44322,42.046661,-72.753372,71,2021,2021-03-27,86
47791,44.570518,-123.278702,77,2022,2022-04-08,98
48039,35.928917,-79.914223,244,2022,2022-04-30,120
48098,42.721954,-73.752441,100,2022,2022-04-27,117
50739,40.691261,-73.963165,20,2023,2023-03-27,86
51102,40.6912,-73.963203,20,2023,2023-03-27,86
50546,41.844032,-71.436195,54,2023,2023-04-18,108
51658,47.837257,-122.215523,72,2023,2023-04-09,99
52046,39.296749,-102.272293,1268,2023,2023-05-04,124
52605,38.038338,-84.5047,296,2023,2023-09-12,255
2348,35.926178,-78.692719,129,2009,2009-03-29,88
2348,35.926178,-78.692719,129,2010,2010-03-24,83
2424,35.875225,-78.737076,118,2010,2010-03-22,81
5399,38.886761,-77.041016,2,2011,2011-04-05,95
8309,39.731804,-104.961166,1639,2014,2014-03-30,89
18536,40.866119,-73.879341,25,2014,2014-05-02,122
18536,40.866119,-73.879341,25,2015,2015-04-29,119
18536,40.866119,-73.879341,25,2016,2016-03-25,85
18536,40.866119,-73.879341,25,2017,2017-04-11,101
18536,40.866119,-73.879341,25,2018,2018-04-18,108
18536,40.866119,-73.879341,25,2019,2019-04-03,93
18536,40.866119,-73.879341,25,2022,2022-04-07,97
18536,40.866119,-73.879341,25,2023,2023-04-09,99
19941,38.451824,-87.360291,160,2015,2015-04-08,98
25451,35.177742,-80.848755,197,2017,2017-03-28,87
25451,35.177742,-80.848755,197,2018,2018-03-23,82
28788,38.984661,-76.93821,24,2018,2018-04-02,92
28790,38.991508,-76.950378,40,2018,2018-04-10,100
28793,38.983994,-76.935974,21,2018,2018-03-27,86
28796,38.984314,-76.940369,38,2018,2018-04-03,93
28797,38.982372,-76.939468,31,2018,2018-04-01,91
28791,38.992157,-76.943802,37,2018,2018-03-06,65
28918,38.988239,-76.943115,40,2018,2018-03-13,72
28752,38.985867,-76.947266,51,2018,2018-04-02,92
28923,38.986008,-76.938278,26,2018,2018-04-03,93
28933,38.989643,-76.940872,26,2018,2018-03-13,72
28934,38.984295,-76.944366,50,2018,2018-04-03,93
28954,38.98613,-76.938805,26,2018,2018-04-03,93
36676,37.987316,-84.401337,309,2020,2020-03-18,78
37620,35.89801,-86.415253,170,2020,2020-03-23,83
37660,40.201962,-75.535255,60,2020,2020-04-13,104
43087,29.531181,106.512856,288,2021,2021-03-11,70
43604,40.94595,-74.017372,7,2021,2021-04-04,94
43923,47.657265,-122.307213,50,2021,2021-04-08,98
43987,47.208603,-122.473312,90,2021,2021-04-12,102
43969,44.567272,-123.26693,69,2021,2021-04-16,106
9044,44.272942,-73.947464,500,2014,2014-05-23,143
9044,44.272942,-73.947464,500,2015,2015-05-18,138
8901,35.590618,-83.470062,1794,2014,2014-05-14,134
8901,35.590618,-83.470062,1794,2015,2015-05-15,135
8901,35.590618,-83.470062,1794,2016,2016-05-17,138
8901,35.590618,-83.470062,1794,2017,2017-05-18,138
8901,35.590618,-83.470062,1794,2019,2019-05-17,137
8901,35.590618,-83.470062,1794,2021,2021-05-28,148
11837,35.562538,-83.497864,2017,2014,2014-06-01,152
11837,35.562538,-83.497864,2017,2015,2015-05-22,142
11837,35.562538,-83.497864,2017,2017,2017-05-18,138
11837,35.562538,-83.497864,2017,2019,2019-05-17,137
11610,47.279659,-92.168053,445,2018,2018-05-28,148
11610,47.279659,-92.168053,445,2019,2019-06-09,160
23676,46.996738,-94.696556,430,2017,2017-05-09,129
23676,46.996738,-94.696556,430,2018,2018-05-16,136
23676,46.996738,-94.696556,430,2019,2019-05-28,148
27269,48.168194,-90.879684,436,2018,2018-05-27,147
38032,44.863602,-78.285202,369,2020,2020-05-20,141
38032,44.863602,-78.285202,369,2021,2021-05-12,132
38032,44.863602,-78.285202,369,2022,2022-05-14,134
38032,44.863602,-78.285202,369,2023,2023-05-08,128
43621,35.572201,-82.626099,651,2021,2021-03-28,87
44183,40.060658,-85.999557,239,2021,2021-04-22,112
1904,47.143215,-93.431,394,2022,2022-05-26,146
1904,47.143215,-93.431,394,2023,2023-05-17,137
33980,44.929199,-93.164223,288,2019,2019-05-20,140
38575,39.756115,-105.030197,1624,2020,2020-04-25,116
42591,39.140896,-86.5159,240,2021,2021-04-06,96
42580,39.693493,-105.081024,1686,2021,2021-05-10,130
43004,38.590019,-121.305397,27,2021,2021-03-21,80
46742,35.485901,-82.997948,820,2022,2022-04-19,109
"""

USA_CLUSTERS_CSV = """cluster,location,lat,long
3,2251,45.4856,-122.855499
4,1841,39.973316,-82.802826
3,8861,41.71357,-121.507545
3,8937,41.709045,-121.514771
0,23040,53.93327,-116.5765
3,27098,44.668655,-123.222923
3,27101,44.611359,-123.329849
0,33735,48.024921,-122.469193
0,29890,48.91993,-122.640564
1,6432,37.799515,-122.412834
1,3,35.879211,-84.172203
1,10918,37.243382,-80.427132
1,8309,39.731804,-104.961166
4,21670,42.330338,-71.049316
1,26673,39.032318,-94.59211
4,26736,40.667068,-73.991501
3,28716,44.935444,-123.031776
1,29913,38.909508,-77.07354
1,29916,38.908012,-77.072189
4,30294,40.733265,-74.666374
4,30300,40.73381,-74.668793
4,30336,40.733189,-74.669708
1,31254,38.891289,-77.03009
4,32789,40.73082,-73.99733
1,36695,37.997528,-84.401024
1,37094,39.065319,-77.117416
4,37671,40.585594,-75.569016
4,37739,40.992794,-73.662766
4,38179,39.891624,-75.028877
1,38113,37.396343,-79.28231
1,40293,38.028393,-84.499519
4,43221,40.879101,-73.147514
3,43839,44.571491,-123.282806
0,43946,47.653053,-122.30777
3,43967,44.576656,-123.282387
3,43970,45.327137,-122.917313
0,43975,47.84,-122.321098
0,43989,47.663101,-122.315498
2,43756,34.689434,135.269272
0,44023,47.381573,-122.233505
4,44322,42.046661,-72.753372
3,47791,44.570518,-123.278702
1,48039,35.928917,-79.914223
4,48098,42.721954,-73.752441
4,50739,40.691261,-73.963165
4,51102,40.6912,-73.963203
4,50546,41.844032,-71.436195
0,51658,47.837257,-122.215523
1,52046,39.296749,-102.272293
1,52605,38.038338,-84.5047
1,2348,35.926178,-78.692719
1,2424,35.875225,-78.737076
1,5399,38.886761,-77.041016
4,18536,40.866119,-73.879341
1,19941,38.451824,-87.360291
1,25451,35.177742,-80.848755
1,28788,38.984661,-76.93821
1,28790,38.991508,-76.950378
1,28793,38.983994,-76.935974
1,28796,38.984314,-76.940369
1,28797,38.982372,-76.939468
1,28791,38.992157,-76.943802
1,28918,38.988239,-76.943115
1,28752,38.985867,-76.947266
1,28923,38.986008,-76.938278
1,28933,38.989643,-76.940872
1,28934,38.984295,-76.944366
1,28954,38.98613,-76.938805
1,36676,37.987316,-84.401337
1,37620,35.89801,-86.415253
4,37660,40.201962,-75.535255
2,43087,29.531181,106.512856
4,43604,40.94595,-74.017372
0,43923,47.657265,-122.307213
0,43987,47.208603,-122.473312
3,43969,44.567272,-123.26693
4,9044,44.272942,-73.947464
1,8901,35.590618,-83.470062
1,11837,35.562538,-83.497864
0,11610,47.279659,-92.168053
0,23676,46.996738,-94.696556
0,27269,48.168194,-90.879684
4,38032,44.863602,-78.285202
1,43621,35.572201,-82.626099
4,44183,40.060658,-85.999557
0,1904,47.143215,-93.431
3,33980,44.929199,-93.164223
1,38575,39.756115,-105.030197
1,42591,39.140896,-86.5159
1,42580,39.693493,-105.081024
1,43004,38.590019,-121.305397
1,46742,35.485901,-82.997948
"""

USA_REPRESENTATIVES_CSV = """cluster,location,lat,long,num_obs
0,51658,53.93327,-90.879684,1
1,52605,39.756115,-76.935974,1
2,43756,34.689434,135.269272,1
3,47791,45.4856,-93.164223,1
4,51102,44.863602,-71.049316,1
"""

SCORING_INPUT_HEADER = "location,tempmax_01,tempmax_02,tempmax_03,tempmax_04,tempmax_05,tempmax_06,tempmax_07,tempmax_08,tempmax_09,tempmax_10,tempmax_11,tempmax_12,tempmin_01,tempmin_02,tempmin_03,tempmin_04,tempmin_05,tempmin_06,tempmin_07,tempmin_08,tempmin_09,tempmin_10,tempmin_11,tempmin_12,temp_01,temp_02,temp_03,temp_04,temp_05,temp_06,temp_07,temp_08,temp_09,temp_10,temp_11,temp_12,dew_01,dew_02,dew_03,dew_04,dew_05,dew_06,dew_07,dew_08,dew_09,dew_10,dew_11,dew_12,humidity_01,humidity_02,humidity_03,humidity_04,humidity_05,humidity_06,humidity_07,humidity_08,humidity_09,humidity_10,humidity_11,humidity_12,precip_01,precip_02,precip_03,precip_04,precip_05,precip_06,precip_07,precip_08,precip_09,precip_10,precip_11,precip_12,precipprob_01,precipprob_02,precipprob_03,precipprob_04,precipprob_05,precipprob_06,precipprob_07,precipprob_08,precipprob_09,precipprob_10,precipprob_11,precipprob_12,precipcover_01,precipcover_02,precipcover_03,precipcover_04,precipcover_05,precipcover_06,precipcover_07,precipcover_08,precipcover_09,precipcover_10,precipcover_11,precipcover_12,snowdepth_01,snowdepth_02,snowdepth_03,snowdepth_04,snowdepth_05,snowdepth_06,snowdepth_07,snowdepth_08,snowdepth_09,snowdepth_10,snowdepth_11,snowdepth_12,windgust_01,windgust_02,windgust_03,windgust_04,windgust_05,windgust_06,windgust_07,windgust_08,windgust_09,windgust_10,windgust_11,windgust_12,windspeed_01,windspeed_02,windspeed_03,windspeed_04,windspeed_05,windspeed_06,windspeed_07,windspeed_08,windspeed_09,windspeed_10,windspeed_11,windspeed_12,windspeedmax_01,windspeedmax_02,windspeedmax_03,windspeedmax_04,windspeedmax_05,windspeedmax_06,windspeedmax_07,windspeedmax_08,windspeedmax_09,windspeedmax_10,windspeedmax_11,windspeedmax_12,windspeedmean_01,windspeedmean_02,windspeedmean_03,windspeedmean_04,windspeedmean_05,windspeedmean_06,windspeedmean_07,windspeedmean_08,windspeedmean_09,windspeedmean_10,windspeedmean_11,windspeedmean_12,windspeedmin_01,windspeedmin_02,windspeedmin_03,windspeedmin_04,windspeedmin_05,windspeedmin_06,windspeedmin_07,windspeedmin_08,windspeedmin_09,windspeedmin_10,windspeedmin_11,windspeedmin_12,sealevelpressure_01,sealevelpressure_02,sealevelpressure_03,sealevelpressure_04,sealevelpressure_05,sealevelpressure_06,sealevelpressure_07,sealevelpressure_08,sealevelpressure_09,sealevelpressure_10,sealevelpressure_11,sealevelpressure_12,cloudcover_01,cloudcover_02,cloudcover_03,cloudcover_04,cloudcover_05,cloudcover_06,cloudcover_07,cloudcover_08,cloudcover_09,cloudcover_10,cloudcover_11,cloudcover_12,solarradiation_01,solarradiation_02,solarradiation_03,solarradiation_04,solarradiation_05,solarradiation_06,solarradiation_07,solarradiation_08,solarradiation_09,solarradiation_10,solarradiation_11,solarradiation_12,solarenergy_01,solarenergy_02,solarenergy_03,solarenergy_04,solarenergy_05,solarenergy_06,solarenergy_07,solarenergy_08,solarenergy_09,solarenergy_10,solarenergy_11,solarenergy_12,uvindex_01,uvindex_02,uvindex_03,uvindex_04,uvindex_05,uvindex_06,uvindex_07,uvindex_08,uvindex_09,uvindex_10,uvindex_11,uvindex_12,day_length_01,day_length_02,day_length_03,day_length_04,day_length_05,day_length_06,day_length_07,day_length_08,day_length_09,day_length_10,day_length_11,day_length_12"
